"""Pipeline inputs derived from whole given tables, as Spark frames and as SQL.

``events`` gives both ingestion paths.  Every event is on the batch path and on
the message path; for two event types both carry the same document (newer,
equal or older on the message path), for the others the message is a document of
its own.  ``supplier`` gives the history of the route reference, ``orders`` the
run log and the operation log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake import fixed_values as fv
from delaylake.functions import to_iso
from delaylake.sources.reference import route_snapshot

NOW = "2024-01-31 00:00:00"
TODAY = "2024-01-31"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUV"


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def today() -> Column:
    return F.lit(TODAY).cast("date")


def _route(number: Column) -> Column:
    return F.when(number < 9, (number + 1).cast("string")).otherwise(
        F.substring(F.lit(LETTERS), (number - 8).cast("int"), F.lit(1))
    )


def _hash_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 32)


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delay event per row of ``events``, with gaps planted in every field."""
    return base_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def base_of(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    rows = events.select(
        e, "user_id", "event_type", "value",
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("sec"),
    )
    sec = F.col("sec")
    return rows.select(
        e,
        "event_type",
        "sec",
        F.when(e % 97 != 0, _route(F.col("user_id") % 31)).alias("route_id"),
        F.when(e % 89 != 0, F.concat_ws("_", F.col("user_id").cast("string"), "event_type")).alias("trip_id"),
        F.when(e % 11 != 0, sec).alias("trip_update_timestamp"),
        F.when(e % 7 == 0, F.lit(None)).when(e % 101 == 0, F.lit(9000))
        .otherwise(F.floor(F.col("value") * 10).cast("int") - 600).cast("int").alias("first_stop_delay_sec"),
        F.concat(F.lit("batch-"), F.expr("sec div 30").cast("string")).alias("ingest_batch_id"),
        (sec + e % 60).alias("ing"),
        _hash_id(F.col("user_id"), sec, e).alias("id"),
        _hash_id(F.col("user_id"), sec, e, F.lit("hub")).alias("other_id"),
    )


def batch(base_rows: DataFrame) -> DataFrame:
    """Bronze rows of the batch path."""
    return base_rows.select(
        "id", "route_id", F.lit(fv.DEFAULT_SOURCE).alias("source"),
        F.col("event_id").cast("string").alias("feed_entity_id"), "trip_id",
        "trip_update_timestamp", "first_stop_delay_sec", "ingest_batch_id",
        F.timestamp_seconds("ing").alias("ingested_at"),
        F.timestamp_seconds(F.col("ing") + 5).alias("lake_ingest_ts"),
    )


def hub_fields(base_rows: DataFrame) -> DataFrame:
    """What the message path carries, before it is wrapped into JSON."""
    shift = F.when(F.col("event_id") % 3 == 0, 0).when(F.col("event_id") % 3 == 1, 30).otherwise(-30)
    shared = F.col("event_type").isin("view", "error")
    return base_rows.select(
        "event_id",
        F.when(shared, F.col("id")).otherwise(F.col("other_id")).alias("id"),
        "route_id", "trip_id", "trip_update_timestamp", "first_stop_delay_sec", "ingest_batch_id",
        F.timestamp_seconds(F.col("ing") + shift).alias("ingested_at"),
        F.timestamp_seconds(F.col("ing") + shift + 3).alias("bronze_ingest_ts"),
    )


def _envelope_json() -> Column:
    return F.to_json(F.struct(
        "id", "route_id",
        F.struct("ingest_batch_id", to_iso("ingested_at").alias("ingested_at"),
                 F.lit(fv.SCHEMA_VERSION).alias("schema_version"),
                 F.lit(fv.DEFAULT_SOURCE).alias("source_system")).alias("metadata"),
        F.struct("trip_id", "trip_update_timestamp", "first_stop_delay_sec",
                 F.col("event_id").cast("string").alias("feed_entity_id")).alias("payload"),
    ))


def hub_raw(base_rows: DataFrame) -> DataFrame:
    """Bronze rows of the message path, payload as JSON text."""
    return hub_fields(base_rows).select(
        F.col("event_id").alias("sequence_number"),
        F.col("event_id").cast("string").alias("offset"),
        F.col("ingested_at").alias("enqueued_time"),
        _envelope_json().alias("payload"),
        "bronze_ingest_ts",
    )


def hub_messages(base_rows: DataFrame) -> DataFrame:
    """The same messages in the broker's column layout."""
    return hub_fields(base_rows).select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        _envelope_json().cast("binary").alias("value"),
        F.lit("events").alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ingested_at").alias("timestamp"),
    )


def stored_docs(base_rows: DataFrame) -> DataFrame:
    """Stored documents as JSON text in both shapes, with modification time ``_ts``."""
    flat = F.col("event_id") % 13 == 0
    iso = to_iso(F.timestamp_seconds("ing"))
    entity = F.col("event_id").cast("string")
    envelope = F.struct(
        "id", "route_id", F.col("ing").alias("_ts"),
        F.struct("ingest_batch_id", iso.alias("ingested_at"),
                 F.lit(fv.DEFAULT_SOURCE).alias("source_system")).alias("metadata"),
        F.struct(entity.alias("feed_entity_id"), "trip_id", "trip_update_timestamp",
                 "first_stop_delay_sec").alias("payload"),
    )
    older = F.struct(
        "id", "route_id", F.col("ing").alias("_ts"), F.lit("flat_feed").alias("source"),
        entity.alias("feed_entity_id"), "trip_id", "trip_update_timestamp", "first_stop_delay_sec",
        "ingest_batch_id", iso.alias("ingested_at"),
    )
    return base_rows.select(
        F.when(flat, F.to_json(older)).otherwise(F.to_json(envelope)).alias("value"),
        F.col("ing").alias("_ts"),
    )


def entities(base_rows: DataFrame) -> DataFrame:
    """Decoded feed entities; the delay sits in a different place by row.

    Entities of one event type are of another kind and carry no trip update.
    """
    e, d = F.col("event_id"), F.col("first_stop_delay_sec")
    none = F.lit(None).cast("int")

    def stop(delay: Column, arrival: Column, departure: Column) -> Column:
        return F.array(F.struct(
            delay.alias("delay"),
            F.struct(arrival.alias("delay")).alias("arrival"),
            F.struct(departure.alias("delay")).alias("departure"),
        ))

    stops = (
        F.when(e % 6 == 0, stop(d, none, none))
        .when(e % 6 == 1, stop(none, d, none))
        .when(e % 6 == 2, stop(none, none, d))
        .when(e % 6 == 3, stop(none, d + 1, d))
        .when(e % 6 == 4, stop(none, none, none))
        .otherwise(F.filter(stop(d, d, d), lambda s: F.lit(False)))
    )
    update = F.struct(
        F.struct("route_id", F.coalesce("trip_id", F.lit("")).alias("trip_id")).alias("trip"),
        F.coalesce("trip_update_timestamp", F.lit(0)).cast("bigint").alias("timestamp"),
        stops.alias("stop_time_update"),
    )
    return base_rows.select(
        e.cast("string").alias("id"),
        F.when(F.col("event_type") != "signup", update).alias("trip_update"),
        "ingest_batch_id",
        F.timestamp_seconds("ing").alias("ingested_at"),
    )


def route_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference records over time, one per supplier; the route is its nation's."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    key = F.col("s_suppkey")
    return s.select(
        _route(F.col("s_nationkey")).alias("route_id"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("route_short_name"),
        F.col("s_name").alias("route_long_name"),
        (F.col("s_nationkey") % 5).cast("string").alias("route_type"),
        key.alias("supplier"),
    )


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze reference snapshots."""
    rows = route_records(spark, sf_dir)
    key = F.col("supplier")
    day = F.date_add(F.lit("2023-01-01").cast("date"), (key % 365).cast("int"))
    return route_snapshot(
        rows, day, F.concat(F.lit("ref-"), key.cast("string")),
        F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + key),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline runs, one per order."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    status = F.col("o_orderstatus")
    return o.select(
        F.concat(F.lit("job "), F.col("o_orderpriority")).alias("job"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderdate").cast("timestamp").alias("started_at"),
        F.when(status == "P", "RUNNING").otherwise("TERMINATED").alias("life_cycle"),
        F.when(status == "F", "FAILED").when(status == "O", "SUCCESS").alias("result"),
        F.col("o_custkey").alias("rows"),
        F.col("o_totalprice").alias("latency_ms"),
        F.lit(None).cast("string").alias("detail"),
    )


def commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table operations, one per order."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(
        F.concat(F.lit("table "), F.col("o_orderpriority")).alias("table_name"),
        F.col("o_orderkey").alias("version"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.when(F.col("o_orderstatus") == "F", "MERGE").otherwise("WRITE").alias("operation"),
        F.col("o_custkey").alias("rows_written"),
    )


def _route_sql(n: str) -> str:
    return (f"CASE WHEN {n} < 9 THEN CAST({n} + 1 AS VARCHAR) "
            f"ELSE substr('{LETTERS}', CAST({n} - 8 AS INTEGER), 1) END")


_FALLBACK_SQL = ",\n    ".join(
    "(" + ", ".join(f"'{v}'" for v in row) + ")" for row in fv.FALLBACK_ROUTES
)

# The same inputs in DuckDB's SQL, prefixed to every oracle query that needs them.
CTES = f"""
base0 AS (
  SELECT event_id, user_id, event_type, value, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events),
base AS (
  SELECT event_id, event_type, sec,
    CASE WHEN event_id % 97 <> 0 THEN {_route_sql('(user_id % 31)')} END AS route_id,
    CASE WHEN event_id % 89 <> 0 THEN user_id || '_' || event_type END AS trip_id,
    CASE WHEN event_id % 11 <> 0 THEN sec END AS trip_update_timestamp,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 9000
         ELSE CAST(floor(value * 10) AS INTEGER) - 600 END AS first_stop_delay_sec,
    'batch-' || (sec // 30) AS ingest_batch_id,
    sec + event_id % 60 AS ing,
    substr(sha256(user_id || '|' || sec || '|' || event_id), 1, 32) AS id,
    substr(sha256(user_id || '|' || sec || '|' || event_id || '|hub'), 1, 32) AS other_id
  FROM base0),
batch AS (
  SELECT id, route_id, 'mta_gtfs_rt' AS source, CAST(event_id AS VARCHAR) AS feed_entity_id, trip_id,
    trip_update_timestamp, first_stop_delay_sec, ingest_batch_id,
    make_timestamp(ing * 1000000) AS ingested_at, make_timestamp((ing + 5) * 1000000) AS lake_ingest_ts
  FROM base),
hub0 AS (
  SELECT *, ing + CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 30 ELSE -30 END AS ing_h FROM base),
hub AS (
  SELECT event_id, CASE WHEN event_type IN ('view', 'error') THEN id ELSE other_id END AS id,
    route_id, trip_id, trip_update_timestamp, first_stop_delay_sec, ingest_batch_id,
    make_timestamp(ing_h * 1000000) AS ingested_at,
    make_timestamp((ing_h + 3) * 1000000) AS bronze_ingest_ts
  FROM hub0),
unioned AS (
  SELECT id, route_id, trip_id, trip_update_timestamp, first_stop_delay_sec, ingest_batch_id,
    ingested_at, 'batch' AS _source FROM batch
  UNION ALL
  SELECT id, route_id, trip_id, trip_update_timestamp, first_stop_delay_sec, ingest_batch_id,
    ingested_at, 'event_hub' FROM hub),
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST,
      CASE WHEN _source = 'batch' THEN 0 ELSE 1 END) AS rn FROM unioned) WHERE rn = 1),
to_silver AS (
  SELECT id AS event_sk, route_id, trip_id,
    coalesce(make_timestamp(trip_update_timestamp * 1000000), ingested_at) AS event_ts,
    first_stop_delay_sec AS delay_sec, ingest_batch_id,
    route_id IS NOT NULL AND trip_id IS NOT NULL AND ingested_at IS NOT NULL AS is_valid, _source
  FROM deduped),
silver AS (SELECT * EXCLUDE (_source) FROM to_silver),
kpi AS (
  SELECT CAST(event_ts AS DATE) AS kpi_date, route_id, count(*) AS trip_update_cnt,
    avg(delay_sec) AS avg_delay_sec, CAST(quantile_disc(delay_sec, 0.95) AS DOUBLE) AS p95_delay_sec
  FROM silver WHERE is_valid GROUP BY 1, 2),
ref AS (
  SELECT {_route_sql('s_nationkey')} AS route_id,
    DATE '2023-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS snapshot_date,
    'N' || s_nationkey AS short_name, s_name AS long_name, CAST(s_nationkey % 5 AS VARCHAR) AS gtfs_type,
    'ref-' || s_suppkey AS ingest_batch_id,
    make_timestamp((CAST(epoch(DATE '2023-01-01' + CAST(s_suppkey % 365 AS INTEGER)) AS BIGINT) + s_suppkey)
      * 1000000) AS ingested_at
  FROM supplier),
ref_routes AS (
  SELECT route_id, short_name AS route_short_name, long_name AS route_long_name,
    CASE gtfs_type WHEN '1' THEN 'SUBWAY' WHEN '2' THEN 'RAILWAY' WHEN '3' THEN 'BUS' ELSE 'OTHER' END
      AS route_type
  FROM (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY snapshot_date DESC, ingested_at DESC)
      AS rn FROM ref) WHERE rn = 1),
fallback(route_id, route_short_name, route_long_name, route_type) AS (VALUES
    {_FALLBACK_SQL}),
seen AS (SELECT DISTINCT route_id FROM batch WHERE route_id IS NOT NULL),
first_seen AS (
  SELECT route_id, CAST(min(ingested_at) AS DATE) AS effective_from FROM batch GROUP BY route_id),
route_source AS (
  SELECT * FROM ref_routes
  UNION ALL
  SELECT s.route_id, coalesce(f.route_short_name, s.route_id), f.route_long_name,
    coalesce(f.route_type, 'UNKNOWN')
  FROM seen s LEFT JOIN fallback f ON s.route_id = f.route_id
  WHERE NOT EXISTS (SELECT 1 FROM ref_routes r WHERE r.route_id = s.route_id)),
dim AS (
  SELECT r.*, coalesce(f.effective_from, DATE '{TODAY}') AS effective_from, CAST(NULL AS DATE) AS effective_to
  FROM route_source r LEFT JOIN first_seen f ON r.route_id = f.route_id),
enriched AS (
  SELECT k.kpi_date, k.route_id, d.route_short_name, d.route_long_name, d.route_type,
    k.trip_update_cnt, k.avg_delay_sec, k.p95_delay_sec
  FROM kpi k LEFT JOIN dim d ON k.route_id = d.route_id AND d.effective_to IS NULL),
flow_batch AS (
  SELECT sha256(id || '_cosmos_' || coalesce(CAST(trip_update_timestamp AS VARCHAR), '')) AS event_sk,
    route_id, trip_id, coalesce(make_timestamp(trip_update_timestamp * 1000000), ingested_at) AS event_ts,
    first_stop_delay_sec AS delay_sec, ingest_batch_id,
    route_id IS NOT NULL AND trip_id IS NOT NULL
      AND (ingested_at IS NOT NULL OR trip_update_timestamp IS NOT NULL) AS is_valid,
    'cosmos_batch' AS source_system FROM batch),
flow_hub AS (
  SELECT sha256(id || '_eh_' || coalesce(CAST(trip_update_timestamp AS VARCHAR), '')) AS event_sk,
    route_id, trip_id, coalesce(make_timestamp(trip_update_timestamp * 1000000), ingested_at) AS event_ts,
    first_stop_delay_sec AS delay_sec, ingest_batch_id,
    route_id IS NOT NULL AND trip_id IS NOT NULL
      AND (ingested_at IS NOT NULL OR trip_update_timestamp IS NOT NULL) AS is_valid,
    'event_hub' AS source_system FROM hub),
flow_all AS (SELECT * FROM flow_batch UNION ALL SELECT * FROM flow_hub),
flow_silver AS (
  SELECT * FROM flow_all WHERE route_id IS NOT NULL AND trip_id IS NOT NULL
    AND (delay_sec IS NULL OR delay_sec BETWEEN -3600 AND 7200) AND event_ts IS NOT NULL),
flow_kpi AS (
  SELECT route_id, CAST(event_ts AS DATE) AS kpi_date, count(*) AS trip_update_cnt,
    avg(delay_sec) AS avg_delay_sec, quantile_disc(delay_sec, 0.95) AS p95_delay_sec
  FROM flow_silver WHERE is_valid GROUP BY 1, 2),
docs AS (
  SELECT id, route_id, CASE WHEN event_id % 13 = 0 THEN 'flat_feed' ELSE 'mta_gtfs_rt' END AS source,
    CAST(event_id AS VARCHAR) AS feed_entity_id, trip_id, trip_update_timestamp, first_stop_delay_sec,
    ingest_batch_id, make_timestamp(ing * 1000000) AS ingested_at, ing AS _ts,
    event_id % 13 = 0 AS is_flat FROM base),
trip_docs AS (
  SELECT substr(sha256(coalesce(trip_id, '') || '|' || coalesce(trip_update_timestamp, 0) || '|' || event_id),
      1, 32) AS id,
    coalesce(route_id, 'UNKNOWN') AS route_id, ingest_batch_id,
    make_timestamp(ing * 1000000) AS ingested_at,
    regexp_matches(coalesce(route_id, 'UNKNOWN'), '^[A-Z]') AS is_stream,
    CAST(event_id AS VARCHAR) AS feed_entity_id, coalesce(trip_id, '') AS trip_id,
    trip_update_timestamp,
    CASE event_id % 6 WHEN 3 THEN first_stop_delay_sec + 1 WHEN 4 THEN NULL WHEN 5 THEN NULL
      ELSE first_stop_delay_sec END AS first_stop_delay_sec
  FROM base WHERE event_type <> 'signup'),
run_log AS (
  SELECT 'job ' || o_orderpriority AS job, o_orderdate AS started_at,
    CASE WHEN o_orderstatus = 'P' THEN 'RUNNING' ELSE 'TERMINATED' END AS life_cycle,
    CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCESS' END AS result FROM orders),
commit_log AS (
  SELECT 'table ' || o_orderpriority AS table_name, o_orderkey AS version, o_orderdate AS ts,
    CASE WHEN o_orderstatus = 'F' THEN 'MERGE' ELSE 'WRITE' END AS operation, o_custkey AS rows_written
  FROM orders)
"""
