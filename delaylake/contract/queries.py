"""The registered queries: one per operator, each with its SQL twin where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from delaylake import fixed_values as fv
from delaylake import storage
from delaylake.config import LakeConfig, shared_dir
from delaylake.contract import inputs as src
from delaylake.functions import (
    delay_label,
    event_time,
    first_stop_delay,
    hour_utc,
    is_stream_route,
    kpi_date,
    kpi_date_by_text,
    route_type_label,
)
from delaylake.operators import bitmaps, combine, facts, kpi, monitor, partials, quality, ranking, routes
from delaylake.operators.upsert import advance_watermark, append_if_absent, upsert
from delaylake.plans import daily, ingest, medallion
from delaylake.session import configure
from delaylake.sources import documents, messages
from delaylake.streaming import flows
from delaylake.streaming.bronze import start_bronze_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, which is how the tables and the twins hold them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


class Inputs:
    """Lazy input frames of one run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def base(self) -> DataFrame:
        return src.base(self.spark, self.sf_dir)

    @property
    def batch(self) -> DataFrame:
        return src.batch(self.base)

    @property
    def raw(self) -> DataFrame:
        return src.hub_raw(self.base)

    @property
    def hub(self) -> DataFrame:
        return messages.parse_hub(self.raw)

    @property
    def ref(self) -> DataFrame:
        return src.reference(self.spark, self.sf_dir)

    @property
    def fallback(self) -> DataFrame:
        return routes.fallback_routes(self.spark)

    @property
    def silver(self) -> DataFrame:
        return facts.silver_fact(self.batch, self.hub)

    @property
    def silver_batch(self) -> DataFrame:
        return facts.to_silver(self.batch)

    @property
    def silver_hub(self) -> DataFrame:
        return facts.to_silver(self.hub)

    @property
    def kpi(self) -> DataFrame:
        return kpi.kpi_daily(self.silver)

    @property
    def dim(self) -> DataFrame:
        return routes.dim_route(self.batch, self.ref, self.fallback, src.today())

    @property
    def enriched(self) -> DataFrame:
        return kpi.enrich(self.kpi, self.dim)

    @property
    def flow_rows(self) -> DataFrame:
        return combine.union_all([facts.silver_from_batch(self.batch), facts.silver_from_hub(self.hub)])

    @property
    def flow_silver(self) -> DataFrame:
        return quality.expect_or_drop(self.flow_rows, quality.SILVER_FACT_RULES)

    @property
    def docs(self) -> DataFrame:
        return documents.parse_docs(src.stored_docs(self.base))

    @property
    def trip_docs(self) -> DataFrame:
        return documents.trip_docs(src.entities(self.base), F.col("ingest_batch_id"), F.col("ingested_at"))


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may use the shared input CTEs."""

    def add(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: plain_times(build(Inputs(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = f"WITH {src.CTES.strip()}\n{sql}"
        return build

    return add


# --- scans, projections, scalar functions -----------------------------------


@query("scan_project", """
SELECT event_id AS id, user_id, event_type AS kind, value FROM events""")
def _(x: Inputs) -> DataFrame:
    return x.table("events").select(F.col("event_id").alias("id"), "user_id", F.col("event_type").alias("kind"), "value")


_BRONZE = """id, route_id, source, feed_entity_id, trip_id, trip_update_timestamp, first_stop_delay_sec,
  ingest_batch_id, ingested_at"""


@query("incremental_slice", f"""
SELECT {_BRONZE}, make_timestamp(1706659200000000) AS lake_ingest_ts FROM docs
WHERE _ts > (SELECT CAST((min(_ts) + max(_ts)) // 2 AS BIGINT) FROM docs)""")
def _(x: Inputs) -> DataFrame:
    docs = src.stored_docs(x.base)
    # The mark is the middle of the whole time range, one value computed in the plan.
    mark = docs.agg(F.expr("(min(_ts) + max(_ts)) div 2").alias("mark")).scalar()
    return documents.flatten_docs(
        documents.parse_docs(documents.incremental_slice(docs, mark)), src.now()
    )


@query("incremental_mark", """
SELECT CAST(max(_ts) AS BIGINT) AS new_mark, count(*) AS fetched FROM docs WHERE _ts > 1704067200""")
def _(x: Inputs) -> DataFrame:
    # 1704067200 is the first second of the data: the mark of an earlier, empty load.
    fresh = documents.incremental_slice(src.stored_docs(x.base), 1704067200)
    return fresh.agg(F.max("_ts").alias("new_mark"), F.count(F.lit(1)).alias("fetched"))


@query("parse_docs", """
SELECT id, route_id, _ts, CASE WHEN is_flat THEN NULL ELSE source END AS envelope_source,
  CASE WHEN is_flat THEN source END AS flat_source,
  CASE WHEN NOT is_flat THEN trip_update_timestamp END AS envelope_epoch,
  CASE WHEN is_flat THEN first_stop_delay_sec END AS flat_delay FROM docs""")
def _(x: Inputs) -> DataFrame:
    return x.docs.select(
        "id", "route_id", "_ts", F.col("metadata.source_system").alias("envelope_source"),
        F.col("source").alias("flat_source"),
        F.col("payload.trip_update_timestamp").alias("envelope_epoch"),
        F.col("first_stop_delay_sec").alias("flat_delay"),
    )


@query("flatten_docs", f"SELECT {_BRONZE}, make_timestamp(1706659200000000) AS lake_ingest_ts FROM docs")
def _(x: Inputs) -> DataFrame:
    return documents.flatten_docs(x.docs, src.now())


@query("shape_messages", """
SELECT event_id AS sequence_number, CAST(event_id AS VARCHAR) AS "offset", ingested_at AS enqueued_time,
  id AS payload_id, make_timestamp(1706659200000000) AS bronze_ingest_ts FROM hub""")
def _(x: Inputs) -> DataFrame:
    shaped = messages.shape_messages(src.hub_messages(x.base), src.now())
    return shaped.select(
        "sequence_number", "offset", "enqueued_time",
        F.get_json_object("payload", "$.id").alias("payload_id"), "bronze_ingest_ts",
    )


@query("parse_hub", """
SELECT id, route_id, trip_id, trip_update_timestamp, first_stop_delay_sec, ingest_batch_id, ingested_at
FROM hub""")
def _(x: Inputs) -> DataFrame:
    return x.hub


@query("route_snapshot", """
SELECT route_id, snapshot_date, ingest_batch_id, ingested_at, short_name, long_name, gtfs_type FROM ref""")
def _(x: Inputs) -> DataFrame:
    return x.ref.select(
        "route_id", "snapshot_date", "ingest_batch_id", "ingested_at",
        F.get_json_object("payload", "$.route_short_name").alias("short_name"),
        F.get_json_object("payload", "$.route_long_name").alias("long_name"),
        F.get_json_object("payload", "$.route_type").alias("gtfs_type"),
    )


@query("trip_docs", """
SELECT id, route_id, feed_entity_id, trip_id, trip_update_timestamp, first_stop_delay_sec, ingest_batch_id
FROM trip_docs""")
def _(x: Inputs) -> DataFrame:
    return x.trip_docs.select(
        "id", "route_id", "payload.feed_entity_id", "payload.trip_id",
        "payload.trip_update_timestamp", "payload.first_stop_delay_sec", "metadata.ingest_batch_id",
    )


@query("first_stop_delay", """
SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_type = 'signup' THEN NULL ELSE
  CASE event_id % 6 WHEN 3 THEN first_stop_delay_sec + 1 WHEN 4 THEN NULL WHEN 5 THEN NULL
  ELSE first_stop_delay_sec END END AS delay FROM base""")
def _(x: Inputs) -> DataFrame:
    return src.entities(x.base).select("id", first_stop_delay("trip_update.stop_time_update").alias("delay"))


@query("segment_split", """
SELECT CASE WHEN is_stream THEN 'stream' ELSE 'batch' END AS segment,
  CASE WHEN is_stream THEN 'gtfs_rt_stream' ELSE 'gtfs_rt_batch' END AS container,
  is_stream AS emit, route_id, count(*) AS docs FROM trip_docs GROUP BY ALL""")
def _(x: Inputs) -> DataFrame:
    batch, stream = documents.route_docs(x.trip_docs)
    return batch.unionByName(stream).groupBy(
        F.col("metadata.segment").alias("segment"),
        F.col("metadata.cosmos_container").alias("container"),
        F.col("metadata.emit_to_event_hub").alias("emit"),
        "route_id",
    ).agg(F.count(F.lit(1)).alias("docs"))


@query("segment_modes", """
SELECT route_id, coalesce(route_id, 'UNKNOWN') IN ('A', '7', 'UNKNOWN') AS explicit,
  regexp_matches(coalesce(route_id, 'UNKNOWN'), '^[A-Z]') AS letter_to_stream,
  NOT regexp_matches(coalesce(route_id, 'UNKNOWN'), '^[0-9]') AS numeric_to_batch,
  regexp_matches(coalesce(route_id, 'UNKNOWN'), '^[0-9]') AS numeric_to_stream,
  false AS other, count(*) AS events FROM base GROUP BY ALL""")
def _(x: Inputs) -> DataFrame:
    return x.base.groupBy("route_id").agg(F.count(F.lit(1)).alias("events")).select(
        "route_id",
        is_stream_route("route_id", "explicit", ["A", "7", "UNKNOWN"]).alias("explicit"),
        *[is_stream_route("route_id", m).alias(m)
          for m in ("letter_to_stream", "numeric_to_batch", "numeric_to_stream", "other")],
        "events",
    )


@query("to_messages", """
SELECT id, route_id, CASE WHEN is_stream THEN 'stream' ELSE 'batch' END AS segment,
  'letter_to_stream' AS segment_mode, '1.0' AS schema_version, 'TripUpdate' AS event_type,
  CASE WHEN is_stream THEN 'true' ELSE 'false' END AS emit, CAST(first_stop_delay_sec AS VARCHAR) AS delay,
  ingested_at FROM trip_docs""")
def _(x: Inputs) -> DataFrame:
    def at(path: str, name: str):
        return F.get_json_object("value", path).alias(name)

    return documents.to_messages(x.trip_docs).select(
        at("$.id", "id"), at("$.route_id", "route_id"), at("$.metadata.segment", "segment"),
        at("$.metadata.segment_mode", "segment_mode"), at("$.metadata.schema_version", "schema_version"),
        at("$.metadata.event_type", "event_type"), at("$.metadata.emit_to_event_hub", "emit"),
        at("$.payload.first_stop_delay_sec", "delay"),
        F.try_to_timestamp(F.get_json_object("value", "$.metadata.ingested_at")).alias("ingested_at"),
    )


@query("event_time", """
SELECT id, coalesce(make_timestamp(trip_update_timestamp * 1000000), ingested_at) AS event_ts FROM batch""")
def _(x: Inputs) -> DataFrame:
    return x.batch.select("id", event_time("trip_update_timestamp", "ingested_at").alias("event_ts"))


@query("event_dates", """
SELECT CAST(event_ts AS DATE) AS by_cast, CAST(event_ts AS DATE) AS by_text,
  CAST(hour(event_ts) AS INTEGER) AS hour_utc, count(*) AS events FROM silver GROUP BY ALL""")
def _(x: Inputs) -> DataFrame:
    return x.silver.groupBy(
        kpi_date().alias("by_cast"), kpi_date_by_text().alias("by_text"), hour_utc().alias("hour_utc")
    ).agg(F.count(F.lit(1)).alias("events"))


@query("validity_flags", """
SELECT is_valid AS strict, CASE WHEN route_id IS NULL THEN 'no route' WHEN trip_id IS NULL THEN 'no trip'
  ELSE 'complete' END AS reason, count(*) AS events FROM silver GROUP BY ALL""")
def _(x: Inputs) -> DataFrame:
    reason = (
        F.when(F.col("route_id").isNull(), "no route").when(F.col("trip_id").isNull(), "no trip")
        .otherwise("complete")
    )
    return x.silver.groupBy(F.col("is_valid").alias("strict"), reason.alias("reason")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query("route_type_label", """
SELECT gtfs_type, CASE gtfs_type WHEN '1' THEN 'SUBWAY' WHEN '2' THEN 'RAILWAY' WHEN '3' THEN 'BUS'
  ELSE 'OTHER' END AS label, count(*) AS snapshots FROM ref GROUP BY ALL""")
def _(x: Inputs) -> DataFrame:
    code = F.get_json_object("payload", "$.route_type")
    return x.ref.groupBy(code.alias("gtfs_type")).agg(F.count(F.lit(1)).alias("snapshots")).select(
        "gtfs_type", route_type_label("gtfs_type").alias("label"), "snapshots"
    )


@query("delay_label", """
SELECT route_id, kpi_date, coalesce(CAST(round(avg_delay_sec, 1) AS VARCHAR), 'N/A') AS avg_delay,
  coalesce(CAST(round(p95_delay_sec, 1) AS VARCHAR), 'N/A') AS p95_delay FROM kpi""")
def _(x: Inputs) -> DataFrame:
    return x.kpi.select(
        "route_id", "kpi_date", delay_label("avg_delay_sec").alias("avg_delay"),
        delay_label("p95_delay_sec").alias("p95_delay"),
    )


# --- union, dedup, silver -----------------------------------------------------


@query("union_sources", "SELECT * FROM unioned")
def _(x: Inputs) -> DataFrame:
    return combine.union_sources(x.batch, x.hub)


@query("source_tags", "SELECT _source, count(*) AS events FROM unioned GROUP BY 1")
def _(x: Inputs) -> DataFrame:
    return combine.union_sources(x.batch, x.hub).groupBy("_source").agg(F.count(F.lit(1)).alias("events"))


@query("union_missing", """
SELECT 'batch' AS path, id, lake_ingest_ts, NULL AS sequence_number FROM batch
UNION ALL SELECT 'hub', id, NULL, event_id FROM hub""")
def _(x: Inputs) -> DataFrame:
    batch = x.batch.select(F.lit("batch").alias("path"), "id", "lake_ingest_ts")
    hub = x.raw.select(
        F.lit("hub").alias("path"), F.get_json_object("payload", "$.id").alias("id"), "sequence_number"
    )
    return combine.union_all([batch, hub], allow_missing=True)


@query("dedup_latest", "SELECT * FROM deduped")
def _(x: Inputs) -> DataFrame:
    return ranking.dedup_latest(combine.union_sources(x.batch, x.hub))


@query("dedup_repeated_keys", """
SELECT * FROM (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice,
  l_quantity FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
    l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) = 1)""")
def _(x: Inputs) -> DataFrame:
    rows = x.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"
    )
    keys = ["l_orderkey", "l_linenumber"]
    return ranking.keep_first(rows, keys, ranking.total_order(rows, keys))


@query("silver_fact", "SELECT * FROM silver")
def _(x: Inputs) -> DataFrame:
    return x.silver


@query("silver_flow_keys", "SELECT event_sk, source_system FROM flow_all")
def _(x: Inputs) -> DataFrame:
    return x.flow_rows.select("event_sk", "source_system")


@query("silver_flows", "SELECT * FROM flow_silver")
def _(x: Inputs) -> DataFrame:
    return x.flow_silver


@query("flow_validity", """
SELECT source_system, is_valid AS either, count(*) AS events FROM flow_all GROUP BY ALL""")
def _(x: Inputs) -> DataFrame:
    return x.flow_rows.groupBy("source_system", F.col("is_valid").alias("either")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query("valid_only", "SELECT event_sk, route_id, event_ts FROM silver WHERE is_valid")
def _(x: Inputs) -> DataFrame:
    return facts.valid_only(x.silver).select("event_sk", "route_id", "event_ts")


# --- upserts ------------------------------------------------------------------

_SILVER_OF = """SELECT id AS event_sk, route_id, trip_id,
  coalesce(make_timestamp(trip_update_timestamp * 1000000), ingested_at) AS event_ts,
  first_stop_delay_sec AS delay_sec, ingest_batch_id,
  route_id IS NOT NULL AND trip_id IS NOT NULL AND ingested_at IS NOT NULL AS is_valid"""


@query("upsert_all", f"""
, t AS ({_SILVER_OF} FROM batch), s AS ({_SILVER_OF} FROM hub)
SELECT * FROM s UNION ALL SELECT * FROM t WHERE event_sk NOT IN (SELECT event_sk FROM s)""")
def _(x: Inputs) -> DataFrame:
    return upsert(x.silver_batch, x.silver_hub, ["event_sk"])


@query("upsert_cols", """
, k AS (SELECT CAST(event_ts AS DATE) AS kpi_date, route_id, path, count(*) AS n, avg(delay_sec) AS a,
    CAST(quantile_disc(delay_sec, 0.95) AS DOUBLE) AS p
  FROM (SELECT *, 'batch' AS path FROM flow_batch UNION ALL SELECT *, 'hub' FROM flow_hub)
  WHERE is_valid GROUP BY 1, 2, 3),
t AS (SELECT * FROM k WHERE path = 'batch'), s AS (SELECT * FROM k WHERE path = 'hub')
SELECT coalesce(t.kpi_date, s.kpi_date) AS kpi_date, coalesce(t.route_id, s.route_id) AS route_id,
  CASE WHEN s.n IS NOT NULL THEN s.n ELSE t.n END AS trip_update_cnt,
  CASE WHEN t.n IS NOT NULL THEN t.a ELSE s.a END AS avg_delay_sec,
  CASE WHEN s.n IS NOT NULL THEN s.p ELSE t.p END AS p95_delay_sec
FROM t FULL JOIN s ON t.kpi_date = s.kpi_date AND t.route_id = s.route_id""")
def _(x: Inputs) -> DataFrame:
    target = kpi.kpi_daily(facts.silver_from_batch(x.batch))
    source = kpi.kpi_daily(facts.silver_from_hub(x.hub))
    return upsert(target, source, ["kpi_date", "route_id"], ["trip_update_cnt", "p95_delay_sec"])


@query("watermark_upsert", f"""
SELECT source_key, CAST(CASE WHEN source_key = 'view' THEN n ELSE m END AS BIGINT) AS last_ts,
  CASE WHEN source_key = 'view' THEN TIMESTAMP '{src.NOW}' ELSE make_timestamp(m * 1000000) END AS updated_at
FROM (SELECT event_type AS source_key, max(ing) AS m, (SELECT max(ing) FROM base) AS n FROM base GROUP BY 1)""")
def _(x: Inputs) -> DataFrame:
    marks = x.base.groupBy(F.col("event_type").alias("source_key")).agg(
        F.max("ing").alias("last_ts"), F.timestamp_seconds(F.max("ing")).alias("updated_at")
    )
    top = x.base.agg(F.max("ing").alias("m")).select("m").scalar()
    return advance_watermark(marks, "view", top, src.now())


@query("snapshot_guard", """
SELECT route_id, snapshot_date, ingest_batch_id FROM ref
WHERE snapshot_date NOT IN (SELECT DATE '2023-01-01' + 4 * s_nationkey FROM supplier)""")
def _(x: Inputs) -> DataFrame:
    stored = x.table("supplier").select(
        F.date_add(F.lit("2023-01-01").cast("date"), 4 * F.col("s_nationkey")).alias("snapshot_date")
    )
    return append_if_absent(x.ref, stored).select("route_id", "snapshot_date", "ingest_batch_id")


# --- route dimension -----------------------------------------------------------


@query("dim_ref", "SELECT * FROM ref_routes")
def _(x: Inputs) -> DataFrame:
    return routes.latest_routes(x.ref)


@query("latest_snapshot", """
SELECT route_id, snapshot_date, short_name, long_name, gtfs_type FROM ref
WHERE snapshot_date = (SELECT max(snapshot_date) FROM ref)""")
def _(x: Inputs) -> DataFrame:
    return ranking.global_latest(x.ref).select(
        "route_id", "snapshot_date",
        F.get_json_object("payload", "$.route_short_name").alias("short_name"),
        F.get_json_object("payload", "$.route_long_name").alias("long_name"),
        F.get_json_object("payload", "$.route_type").alias("gtfs_type"),
    )


@query("routes_seen", "SELECT * FROM seen")
def _(x: Inputs) -> DataFrame:
    return routes.routes_seen(x.batch)


@query("first_seen", "SELECT * FROM first_seen")
def _(x: Inputs) -> DataFrame:
    return routes.first_seen(x.batch)


@query("fact_only_routes", "SELECT * FROM seen WHERE route_id NOT IN (SELECT route_id FROM ref_routes)")
def _(x: Inputs) -> DataFrame:
    return routes.fact_only_routes(x.batch, routes.latest_routes(x.ref))


@query("dim_fallback", """
SELECT s.route_id, coalesce(f.route_short_name, s.route_id) AS route_short_name, f.route_long_name,
  coalesce(f.route_type, 'UNKNOWN') AS route_type FROM seen s LEFT JOIN fallback f ON s.route_id = f.route_id""")
def _(x: Inputs) -> DataFrame:
    return routes.with_fallback(routes.routes_seen(x.batch), x.fallback)


@query("route_source", "SELECT * FROM route_source")
def _(x: Inputs) -> DataFrame:
    return routes.resolve_routes(x.batch, x.ref, x.fallback)


@query("dim_first_seen", "SELECT * FROM dim")
def _(x: Inputs) -> DataFrame:
    resolved = routes.resolve_routes(x.batch, x.ref, x.fallback)
    return routes.with_first_seen(resolved, x.batch, src.today())


@query("dim_route", "SELECT * FROM dim")
def _(x: Inputs) -> DataFrame:
    return x.dim


@query("dim_upsert", """
, t AS (SELECT r.route_id, r.route_short_name, r.route_long_name, r.route_type, DATE '2023-01-01' AS effective_from,
  CAST(NULL AS DATE) AS effective_to FROM ref_routes r)
SELECT * FROM dim UNION ALL SELECT * FROM t WHERE route_id NOT IN (SELECT route_id FROM dim)""")
def _(x: Inputs) -> DataFrame:
    stored = routes.latest_routes(x.ref).select(
        "*", F.lit("2023-01-01").cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
    )
    return routes.scd1_upsert(stored, x.dim)


@query("active_routes", """
SELECT route_id, effective_from FROM (SELECT route_id, effective_from,
  CASE WHEN route_type = 'OTHER' THEN effective_from END AS effective_to FROM dim) WHERE effective_to IS NULL""")
def _(x: Inputs) -> DataFrame:
    ended = F.when(F.col("route_type") == "OTHER", F.col("effective_from"))
    return routes.active_routes(x.dim.withColumn("effective_to", ended)).select("route_id", "effective_from")


# --- KPIs and reports -----------------------------------------------------------


@query("kpi_daily", "SELECT * FROM kpi")
def _(x: Inputs) -> DataFrame:
    return x.kpi


@query("kpi_daily_flow", "SELECT * FROM flow_kpi")
def _(x: Inputs) -> DataFrame:
    return kpi.kpi_daily(x.flow_silver, cast_p95=False)


@query("kpi_enriched", "SELECT * FROM enriched")
def _(x: Inputs) -> DataFrame:
    return x.enriched


@query("kpi_enriched_flow", """
SELECT k.kpi_date, k.route_id, d.route_short_name, d.route_long_name, d.route_type, k.trip_update_cnt,
  k.avg_delay_sec, k.p95_delay_sec FROM flow_kpi k LEFT JOIN dim d ON k.route_id = d.route_id""")
def _(x: Inputs) -> DataFrame:
    return kpi.enrich_flow(kpi.kpi_daily(x.flow_silver, cast_p95=False), kpi.flow_dim_route(x.dim))


@query("daily_summary", """
SELECT kpi_date, count(DISTINCT route_id) AS routes_active, CAST(sum(trip_update_cnt) AS BIGINT)
  AS total_trip_updates, round(avg(avg_delay_sec), 1) AS overall_avg_delay_sec FROM kpi GROUP BY 1""")
def _(x: Inputs) -> DataFrame:
    return kpi.daily_summary(x.kpi)


@query("active_route_count", "SELECT count(DISTINCT route_id) AS active_routes FROM kpi")
def _(x: Inputs) -> DataFrame:
    return kpi.active_route_count(x.kpi)


@query("total_updates", "SELECT CAST(sum(trip_update_cnt) AS BIGINT) AS total_updates FROM enriched")
def _(x: Inputs) -> DataFrame:
    return kpi.total_updates(x.enriched)


@query("latest_date", "SELECT max(kpi_date) AS latest_date FROM enriched")
def _(x: Inputs) -> DataFrame:
    return kpi.latest_date(x.enriched)


@query("updates_by_route", """
SELECT route_short_name, CAST(sum(trip_update_cnt) AS BIGINT) AS trip_updates FROM enriched GROUP BY 1""")
def _(x: Inputs) -> DataFrame:
    return ranking.sorted_desc(kpi.updates_by_route(x.enriched), "trip_updates")


@query("hourly_volume", """
SELECT route_id, CAST(hour(event_ts) AS INTEGER) AS hour_utc, count(event_sk) AS events
FROM silver WHERE is_valid GROUP BY 1, 2""")
def _(x: Inputs) -> DataFrame:
    return kpi.hourly_volume(x.silver)


@query("route_detail", """
SELECT route_short_name, route_long_name, route_type,
  coalesce(CAST(round(avg_delay_sec, 1) AS VARCHAR), 'N/A') AS avg_delay,
  coalesce(CAST(round(p95_delay_sec, 1) AS VARCHAR), 'N/A') AS p95_delay,
  CAST(sum(trip_update_cnt) AS BIGINT) AS trip_updates FROM enriched GROUP BY 1, 2, 3, 4, 5""")
def _(x: Inputs) -> DataFrame:
    return kpi.route_detail(x.enriched)


@query("fact_by_route", """
SELECT route_id, count(*) AS events, CAST(count(*) FILTER (is_valid) AS BIGINT) AS valid_events,
  avg(delay_sec) AS avg_delay_sec, min(event_ts) AS earliest, max(event_ts) AS latest
FROM silver GROUP BY 1""")
def _(x: Inputs) -> DataFrame:
    return ranking.report(facts.fact_by_route(x.silver), F.desc("events"), F.asc("route_id"))


@query("route_breakdown", """
SELECT coalesce(route_id, 'UNKNOWN') AS route_id, count(*) AS document_count FROM hub GROUP BY 1""")
def _(x: Inputs) -> DataFrame:
    return facts.route_breakdown(messages.message_routes(x.raw), "UNKNOWN")


@query("route_breakdown_batch", "SELECT route_id, count(*) AS document_count FROM batch GROUP BY 1")
def _(x: Inputs) -> DataFrame:
    return facts.route_breakdown(x.batch)


@query("newest_rows", f"""
SELECT {_BRONZE}, lake_ingest_ts FROM batch ORDER BY lake_ingest_ts DESC, id DESC NULLS LAST LIMIT 20""")
def _(x: Inputs) -> DataFrame:
    return ranking.newest(x.batch, "lake_ingest_ts", 20)


@query("row_count", "SELECT count(*) AS row_count FROM silver")
def _(x: Inputs) -> DataFrame:
    return monitor.row_count(x.silver)


# --- quality and monitoring -------------------------------------------------------


@query("expect_counts", """
, r AS (SELECT 'bronze' AS dataset, 'valid_id' AS rule, count(*) FILTER (id IS NULL) AS violations,
    count(*) AS checked_rows FROM batch
  UNION ALL SELECT 'bronze', 'valid_route_id', count(*) FILTER (route_id IS NULL), count(*) FROM batch
  UNION ALL SELECT 'bronze', 'has_timestamp',
    count(*) FILTER (trip_update_timestamp IS NULL AND ingested_at IS NULL), count(*) FROM batch
  UNION ALL SELECT 'gold', 'valid_kpi_date', count(*) FILTER (kpi_date IS NULL), count(*) FROM flow_kpi
  UNION ALL SELECT 'gold', 'valid_route', count(*) FILTER (route_id IS NULL), count(*) FROM flow_kpi
  UNION ALL SELECT 'gold', 'positive_trip_count', count(*) FILTER (trip_update_cnt <= 0), count(*) FROM flow_kpi)
SELECT dataset, rule, CAST(violations AS BIGINT) AS violations, checked_rows FROM r""")
def _(x: Inputs) -> DataFrame:
    gold = kpi.kpi_daily(x.flow_silver, cast_p95=False)
    parts = {
        "bronze": quality.violation_counts(x.batch, quality.BRONZE_BATCH_RULES),
        "gold": quality.violation_counts(gold, quality.GOLD_KPI_RULES),
    }
    return combine.union_all([df.select(F.lit(n).alias("dataset"), "*") for n, df in parts.items()])


@query("expect_drop", """
SELECT event_sk, route_id, trip_id, delay_sec FROM flow_batch WHERE route_id IS NOT NULL AND trip_id IS NOT NULL
  AND (delay_sec IS NULL OR delay_sec BETWEEN -3600 AND 7200) AND event_ts IS NOT NULL""")
def _(x: Inputs) -> DataFrame:
    rows = facts.silver_from_batch(x.batch)
    return quality.expect_or_drop(rows, quality.SILVER_FACT_RULES).select(
        "event_sk", "route_id", "trip_id", "delay_sec"
    )


@query("expect_fail", "SELECT * FROM dim")
def _(x: Inputs) -> DataFrame:
    return quality.expect_or_fail(x.dim, quality.DIM_ROUTE_RULES)


_PROFILE = """profile AS (
  SELECT count(*) AS total_events, CAST(count(*) FILTER (is_valid) AS BIGINT) AS valid_events,
    CAST(count(*) FILTER (NOT is_valid) AS BIGINT) AS invalid_events,
    round(100.0::DOUBLE * count(*) FILTER (is_valid) / count(*), 2) AS valid_pct,
    count(DISTINCT route_id) AS distinct_routes, count(delay_sec) AS has_delay_cnt,
    CAST(count(*) FILTER (event_ts IS NULL) AS BIGINT) AS null_event_ts FROM silver)"""


@query("quality_profile", f", {_PROFILE} SELECT * FROM profile")
def _(x: Inputs) -> DataFrame:
    return quality.quality_profile(x.silver)


@query("quality_status", f"""
, {_PROFILE} SELECT valid_pct, CASE WHEN valid_pct IS NULL THEN 'EMPTY' WHEN valid_pct < 95 THEN 'LOW'
  ELSE 'OK' END AS status FROM profile""")
def _(x: Inputs) -> DataFrame:
    return quality.quality_status(quality.quality_profile(x.silver))


@query("freshness_raw", """
SELECT count(*) AS row_count, min(event_ts) AS earliest, max(event_ts) AS latest FROM silver""")
def _(x: Inputs) -> DataFrame:
    return monitor.extent(x.silver, "event_ts")


def _fresh(x: Inputs) -> DataFrame:
    return monitor.freshness([
        ("bronze.gtfs_rt_events", x.batch, "lake_ingest_ts", 24),
        ("bronze.eventhub_gtfs_raw", x.raw, "bronze_ingest_ts", 2),
        ("bronze.dim_route_ref", x.ref, "ingested_at", 168),
        ("silver.fact_trip_delay_event", x.silver, "event_ts", 24),
        ("gold.route_delay_kpi_daily", x.kpi, "kpi_date", 48),
    ], src.now())


_FRESH = f"""top AS (
  SELECT 'bronze.gtfs_rt_events' AS table_name, count(*) AS row_count, max(lake_ingest_ts) AS latest,
    24 AS threshold_hours FROM batch
  UNION ALL SELECT 'bronze.eventhub_gtfs_raw', count(*), max(bronze_ingest_ts), 2 FROM hub
  UNION ALL SELECT 'bronze.dim_route_ref', count(*), max(ingested_at), 168 FROM ref
  UNION ALL SELECT 'silver.fact_trip_delay_event', count(*), max(event_ts), 24 FROM silver),
aged AS (
  SELECT table_name, row_count, substr(CAST(latest AS VARCHAR), 1, 19) AS latest,
    (epoch_us(TIMESTAMP '{src.NOW}') - epoch_us(latest)) / 3600000000.0::DOUBLE AS age, threshold_hours FROM top
  UNION ALL
  SELECT 'gold.route_delay_kpi_daily', count(*), CAST(max(kpi_date) AS VARCHAR),
    date_diff('day', max(kpi_date), DATE '{src.TODAY}') * 24.0::DOUBLE, 48 FROM kpi),
fresh AS (
  SELECT table_name, row_count, latest, round(age, 1) AS age_hours, CAST(threshold_hours AS INTEGER)
    AS threshold_hours, CASE WHEN age > threshold_hours THEN 'STALE' ELSE 'OK' END AS status FROM aged)"""


@query("freshness", f", {_FRESH} SELECT * FROM fresh")
def _(x: Inputs) -> DataFrame:
    return _fresh(x)


def _runs(x: Inputs) -> DataFrame:
    log = src.run_log(x.spark, x.sf_dir)
    # "Now" is the end of the log's first year: the window is that year.
    return monitor.run_health(log, log.select("job").distinct(), F.lit("1996-01-01").cast("timestamp"), 24 * 365)


_RUNS = """recent AS (SELECT * FROM run_log WHERE started_at >= TIMESTAMP '1996-01-01' - INTERVAL 365 DAYS),
runs AS (
  SELECT job, runs, success, failed, running, cancelled,
    CASE WHEN failed > 0 THEN 'FAILURES' WHEN runs = 0 THEN 'NO RUNS' ELSE 'HEALTHY' END AS status
  FROM (SELECT j.job, count(r.job) AS runs, count(*) FILTER (r.result = 'SUCCESS') AS success,
      count(*) FILTER (r.result = 'FAILED') AS failed, count(*) FILTER (r.life_cycle = 'RUNNING') AS running,
      count(*) FILTER (r.result = 'CANCELED') AS cancelled
    FROM (SELECT DISTINCT job FROM run_log) j LEFT JOIN recent r ON j.job = r.job GROUP BY 1))"""


@query("run_health", f", {_RUNS} SELECT * FROM runs")
def _(x: Inputs) -> DataFrame:
    return _runs(x)


@query("recent_ops", """
SELECT table_name, version, ts, operation, rows_written FROM commit_log
QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY version DESC) <= 5""")
def _(x: Inputs) -> DataFrame:
    return monitor.recent_ops(src.commit_log(x.spark, x.sf_dir), 5)


@query("health_report", f"""
, {_PROFILE}, {_FRESH}, {_RUNS},
t AS (SELECT count(*) AS tables, count(*) FILTER (status = 'STALE') AS stale FROM fresh),
j AS (SELECT count(*) AS jobs, count(*) FILTER (failed > 0) AS bad FROM runs),
c AS (SELECT *, concat_ws(', ', CASE WHEN stale > 0 THEN stale || ' stale table(s)' END,
    CASE WHEN bad > 0 THEN bad || ' failed job(s)' END,
    CASE WHEN valid_pct IS NULL THEN 'no silver events' WHEN valid_pct < 95
      THEN 'quality at ' || valid_pct || '%' END) AS reasons FROM t, j, profile)
SELECT tables, tables - stale AS fresh_tables, jobs, jobs - bad AS healthy_jobs, valid_pct, total_events,
  distinct_routes, CASE WHEN reasons = '' THEN 'HEALTHY' ELSE 'NEEDS ATTENTION' END AS overall_status, reasons
FROM c""")
def _(x: Inputs) -> DataFrame:
    return monitor.health_report(_fresh(x), _runs(x), quality.quality_profile(x.silver))


# --- stored tables and streams, run to their end and read back -----------------------


def _lake(x: Inputs) -> LakeConfig:
    """A new lake in the cluster's shared folder (under the warehouse where none is set)."""
    root = shared_dir(x.spark, x.spark.conf.get("spark.sql.warehouse.dir") + "/_lakes")
    return LakeConfig(root=f"{root}/{uuid.uuid4().hex}")


def _event_stream(x: Inputs) -> DataFrame:
    reader = x.spark.readStream.schema(x.table("events").schema)
    return reader.option("pathGlobFilter", "events.parquet").parquet(x.sf_dir)


def _named_routes(base: DataFrame) -> DataFrame:
    """The stored contract needs a route; the feed names unknown ones so."""
    return base.withColumn("route_id", F.coalesce("route_id", F.lit(fv.UNKNOWN_ROUTE)))


@query("stream_to_bronze", """
SELECT event_id AS sequence_number, CAST(event_id AS VARCHAR) AS "offset", ingested_at AS enqueued_time,
  id AS payload_id FROM hub""")
def _(x: Inputs) -> DataFrame:
    cfg = _lake(x)
    messages_in = src.hub_messages(src.base_of(_event_stream(x)))
    start_bronze_stream(messages_in, cfg, available_now=True).awaitTermination()
    return storage.read_table(x.spark, cfg, medallion.HUB).select(
        "sequence_number", "offset", "enqueued_time",
        F.get_json_object("payload", "$.id").alias("payload_id"),
    )


@query("stream_append_flows", "SELECT * FROM flow_silver")
def _(x: Inputs) -> DataFrame:
    cfg = _lake(x)

    def flow(name: str, rows: Callable[[DataFrame], DataFrame]) -> flows.Flow:
        def go():
            shaped = rows(src.base_of(_event_stream(x)))
            checked = quality.expect_or_drop(shaped, quality.SILVER_FACT_RULES, name)
            return flows.append_flow(name, checked, cfg)

        return flows.Flow(name, go)

    report = flows.run_flows([
        flow("batch_to_silver", lambda b: facts.silver_from_batch(src.batch(b))),
        flow("hub_to_silver", lambda b: facts.silver_from_hub(messages.parse_hub(src.hub_raw(b)))),
    ])
    if report.failures:
        raise RuntimeError(str(report.failures))
    return storage.read_table(x.spark, cfg, flows.SILVER)


def _stored_run(x: Inputs, incremental: bool) -> LakeConfig:
    cfg = _lake(x)
    base = _named_routes(x.base)
    storage.append(src.hub_raw(base), cfg, medallion.HUB, "hub")
    records = src.route_records(x.spark, x.sf_dir).drop("supplier")
    daily.run_daily(
        x.spark, cfg, src.stored_docs(base), records, src.TODAY, src.now(), incremental=incremental
    )
    return cfg


_STORED = """stored AS (
  SELECT event_sk, coalesce(route_id, 'UNKNOWN') AS route_id, trip_id, event_ts, delay_sec, ingest_batch_id,
    trip_id IS NOT NULL AND event_ts IS NOT NULL AS is_valid FROM silver)"""


@query("daily_run_gold", f"""
, {_STORED}
SELECT CAST(event_ts AS DATE) AS kpi_date, route_id, count(*) AS trip_update_cnt, avg(delay_sec) AS avg_delay_sec,
  CAST(quantile_disc(delay_sec, 0.95) AS DOUBLE) AS p95_delay_sec FROM stored WHERE is_valid GROUP BY 1, 2""")
def _(x: Inputs) -> DataFrame:
    return storage.read_table(x.spark, _stored_run(x, incremental=False), medallion.GOLD)


@query("incremental_run_silver", f", {_STORED} SELECT * FROM stored")
def _(x: Inputs) -> DataFrame:
    return storage.read_table(x.spark, _stored_run(x, incremental=True), medallion.SILVER)


@query("daily_run_branches", f"""
, {_STORED}, stored_kpi AS (
SELECT CAST(event_ts AS DATE) AS kpi_date, route_id, count(*) AS trip_update_cnt, avg(delay_sec) AS avg_delay_sec
  FROM stored WHERE is_valid GROUP BY 1, 2)
SELECT k.*, d.route_short_name, d.route_type, d.effective_from FROM stored_kpi k JOIN dim d USING (route_id)""")
def _(x: Inputs) -> DataFrame:
    cfg = _stored_run(x, incremental=False)
    gold, dim = (storage.read_table(x.spark, cfg, t) for t in (medallion.GOLD, medallion.DIM))
    named = gold.join(dim.filter(F.col("route_id") != fv.UNKNOWN_ROUTE), "route_id")
    return named.select(
        "kpi_date", "route_id", "trip_update_cnt", "avg_delay_sec", "route_short_name", "route_type", "effective_from"
    )


@query("freshness_stored", f"""
, {_STORED}, top AS (
  SELECT 'bronze.gtfs_rt_events' AS table_name, count(*) AS row_count, TIMESTAMP '{src.NOW}' AS latest,
    24 AS threshold_hours FROM batch
  UNION ALL SELECT 'bronze.eventhub_gtfs_raw', count(*), max(bronze_ingest_ts), 2 FROM hub
  UNION ALL SELECT 'silver.fact_trip_delay_event', count(*), max(event_ts), 24 FROM stored),
aged AS (
  SELECT table_name, row_count, substr(CAST(latest AS VARCHAR), 1, 19) AS latest,
    (epoch_us(TIMESTAMP '{src.NOW}') - epoch_us(latest)) / 3600000000.0::DOUBLE AS age, threshold_hours FROM top
  UNION ALL
  SELECT 'gold.route_delay_kpi_daily', count(*), CAST(max(kpi_date) AS VARCHAR),
    date_diff('day', max(kpi_date), DATE '{src.TODAY}') * 24.0::DOUBLE, 48
  FROM (SELECT DISTINCT CAST(event_ts AS DATE) AS kpi_date, route_id FROM stored WHERE is_valid))
SELECT table_name, row_count, latest, round(age, 1) AS age_hours, CAST(threshold_hours AS INTEGER)
    AS threshold_hours, CASE WHEN age > threshold_hours THEN 'STALE' ELSE 'OK' END AS status FROM aged""")
def _(x: Inputs) -> DataFrame:
    cfg = _stored_run(x, incremental=False)
    names = (medallion.EVENTS, medallion.HUB, medallion.SILVER, medallion.GOLD)
    return monitor.freshness_of(
        [(n, storage.stored_extent(x.spark, cfg, n), cfg.spec(n).stale_hours) for n in names], src.now()
    )


@query("kpi_from_partials", "SELECT * FROM flow_kpi")
def _(x: Inputs) -> DataFrame:
    cfg = _lake(x)
    for name, rows in (("batch", facts.silver_from_batch(x.batch)), ("hub", facts.silver_from_hub(x.hub))):
        storage.append(quality.expect_or_drop(rows, quality.SILVER_FACT_RULES), cfg, flows.SILVER, name)
        # Gold takes in what is new, and no event twice.
        flows.partials_flow(x.spark, cfg).awaitTermination()
    return partials.kpi_from_partials(storage.read_table(x.spark, cfg, flows.PARTIALS))


@query("distinct_routes_by_period", """
, days AS (SELECT CAST(event_ts AS DATE) AS d, route_id FROM silver WHERE event_ts IS NOT NULL),
spans AS (
  SELECT 'day' AS period, d AS start, route_id FROM days
  UNION ALL SELECT 'week', CAST(date_trunc('week', d) AS DATE), route_id FROM days
  UNION ALL SELECT 'month', CAST(date_trunc('month', d) AS DATE), route_id FROM days
  UNION ALL SELECT 'all', (SELECT min(d) FROM days WHERE route_id IS NOT NULL), route_id FROM days)
SELECT period, start, count(DISTINCT route_id) AS distinct_keys FROM spans WHERE route_id IS NOT NULL GROUP BY 1, 2""")
def _(x: Inputs) -> DataFrame:
    numbers = bitmaps.numbered(x.dim, "route_id")
    days = bitmaps.day_bitmaps(x.silver, numbers, "route_id", F.to_date("event_ts"))
    return bitmaps.distinct_by_period(days)


@query("poll_cycle_stores", """
SELECT CASE WHEN is_stream THEN 'stream' ELSE 'batch' END AS segment, is_stream AS sent, id, route_id,
  first_stop_delay_sec FROM trip_docs""")
def _(x: Inputs) -> DataFrame:
    cfg, sent = _lake(x), f"{_lake(x).root}/sent"
    entities = src.entities(x.base)

    def lose(_values: DataFrame) -> None:
        raise ConnectionError("the receiver is away")

    # The first poll stores and fails to send; its repeat sends what was stored.
    for send in (lose, lambda values: values.write.parquet(sent)):
        try:
            ingest.ingest_cycle(x.spark, cfg, entities, "poll-1", src.now(), send=send)
        except ConnectionError:
            continue
    fields = ("id", "route_id", "payload.first_stop_delay_sec")
    ids = documents.parse_docs(x.spark.read.parquet(sent)).select(F.col("id").alias("sent_id")).distinct()
    docs = combine.union_all([
        documents.parse_docs(ingest.stored_documents(x.spark, cfg, s)).select(F.lit(s).alias("segment"), *fields)
        for s in ("batch", "stream")
    ])
    known = docs.join(ids, docs["id"] == ids["sent_id"], "left")
    return known.select("segment", F.col("sent_id").isNotNull().alias("sent"), "id", "route_id", "first_stop_delay_sec")
