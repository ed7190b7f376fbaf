"""Bronze to silver to gold: full rebuild by upsert, and the same result incrementally."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from delaylake import fixed_values as fv
from delaylake import schemas, storage
from delaylake.config import LakeConfig
from delaylake.operators import kpi, ranking, routes
from delaylake.operators.combine import tag_source, union_all, union_sources
from delaylake.operators.facts import to_stored_silver
from delaylake.sources.messages import parse_hub

EVENTS, HUB, REFERENCE = "bronze.gtfs_rt_events", "bronze.eventhub_gtfs_raw", "bronze.dim_route_ref"
CHANGED = "ops.changed_days"
SILVER, DIM, GOLD = "silver.fact_trip_delay_event", "silver.dim_route", "gold.route_delay_kpi_daily"


def stage_silver(spark: SparkSession, cfg: LakeConfig, seen: Observation | None = None) -> DataFrame:
    """Silver rows of all of bronze, one per document."""
    events = union_sources(
        storage.read_table(spark, cfg, EVENTS), parse_hub(storage.read_table(spark, cfg, HUB))
    )
    return to_stored_silver(ranking.dedup_latest(_acceptable(events, seen)))


def _acceptable(events: DataFrame, seen: Observation | None) -> DataFrame:
    """Rows that silver can hold; the others stay in bronze and are counted, on the full and the incremental path alike.

    A row without id (an unreadable message among them) can never match in an upsert, so every re-run would add it
    again. Silver requires a route. A feed time must lie from 2000 to 2099 in epoch seconds: others
    (milliseconds, say) would open partitions that no calendar has. Missing times are allowed.
    """
    first, end = fv.FEED_TIME_RANGE
    faults = {
        "without_id": F.col("id").isNull(),
        "without_route": F.col("id").isNotNull() & F.col("route_id").isNull(),
        "out_of_range": F.col("id").isNotNull() & F.col("route_id").isNotNull()
        & ~F.coalesce(F.col("trip_update_timestamp").between(first, end - 1), F.lit(True)),
    }
    if seen is not None:
        events = events.observe(seen, *[F.count_if(c).alias(n) for n, c in faults.items()])
    return events.filter(~reduce(lambda a, b: a | b, faults.values()))


def _log_rejected(spark: SparkSession, cfg: LakeConfig, seen: Observation) -> None:
    rows = [
        storage.run_row(spark, f"silver_{fault}", uuid.uuid4().hex, F.current_timestamp(), "SUCCESS", rejected, None)
        for fault, rejected in seen.get.items() if rejected
    ]
    if rows:
        storage.log_runs(union_all(rows), cfg)


def run_silver(spark: SparkSession, cfg: LakeConfig) -> int | None:
    """Upsert silver from all of bronze, keyed by the document id."""
    seen = Observation()
    version = storage.upsert_table(stage_silver(spark, cfg, seen), cfg, SILVER, ["event_sk"])
    _log_rejected(spark, cfg, seen)
    if version is not None:
        storage.log_commit(spark, cfg, SILVER, version, "MERGE", None)
    return version


def merge_new_events(spark: SparkSession, cfg: LakeConfig, new: DataFrame) -> list[date | None]:
    """Upsert newly arrived bronze rows; returns the days whose partitions changed.

    Only days that hold one of the new ids, before or after, are rewritten.  The
    stored winner carries the columns it was ranked by, so ranking it against the
    new rows gives what a rebuild from all of bronze would.
    """
    seen = Observation()
    rows = ranking.dedup_stored(to_stored_silver(_acceptable(new, seen))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stored = storage.read_stored(spark, cfg, SILVER)
        ids = rows.select("event_sk")
        before = stored.select("event_sk", "event_date").join(ids, "event_sk", "left_semi")
        # A list of days, bounded by the calendar: feed times outside of 2000 to 2099 were set aside, ingestion times are the lake's own.
        days = [r[0] for r in before.select("event_date").union(rows.select("event_date")).distinct().collect()]
        _log_rejected(spark, cfg, seen)
        if not days:
            return []
        touched = F.col("event_date").isin([d for d in days if d is not None])
        if None in days:
            touched = touched | F.col("event_date").isNull()
        kept = stored.filter(touched)
        merged = ranking.dedup_stored(kept.unionByName(rows))
        # Noted before silver changes: a run that stops in between makes gold recompute a day for nothing, never miss one.
        noted = spark.createDataFrame([(d,) for d in days], schemas.CHANGED_DAYS)
        storage.append(noted, cfg, CHANGED, uuid.uuid4().hex)
        version = storage.publish(merged, cfg, SILVER, replaces=days)
        storage.log_commit(spark, cfg, SILVER, version, "MERGE", None)
        return days
    finally:
        rows.unpersist()


def stream_silver(spark: SparkSession, cfg: LakeConfig, max_files: int | None = None) -> list[date | None]:
    """Incremental silver: a stream over both bronze tables, run until it has caught up.

    The checkpoint remembers which loads are merged; a repeated micro-batch merges
    to the same table.
    """
    batch = tag_source(storage.stream_table(spark, cfg, EVENTS, max_files), fv.TAG_BATCH)
    hub = tag_source(parse_hub(storage.stream_table(spark, cfg, HUB, max_files)), fv.TAG_HUB)
    changed: set[date | None] = set()

    def merge(rows: DataFrame, _batch_id: int) -> None:
        changed.update(merge_new_events(rows.sparkSession, cfg, rows))

    stream = (
        batch.unionByName(hub).writeStream.foreachBatch(merge)
        .option("checkpointLocation", cfg.checkpoint("silver_incremental"))
        .trigger(availableNow=True).start()
    )
    stream.awaitTermination()
    return sorted(changed, key=lambda d: (d is None, d or date.min))


def run_dimension(spark: SparkSession, cfg: LakeConfig, today: Column | None = None) -> int | None:
    """Upsert the route dimension; attributes are overwritten, no history is kept."""
    today = F.current_date() if today is None else today
    staged = routes.dim_route(
        storage.read_table(spark, cfg, EVENTS), storage.read_table(spark, cfg, REFERENCE),
        routes.fallback_routes(spark), today,
    )
    version = storage.upsert_table(
        staged, cfg, DIM, ["route_id"], [c for c in staged.columns if c != "route_id"]
    )
    if version is not None:
        storage.log_commit(spark, cfg, DIM, version, "MERGE", None)
    return version


def run_gold(spark: SparkSession, cfg: LakeConfig, days: list[date | None] | None = None) -> int | None:
    """Upsert the daily KPIs of all of silver, or of the given days only.

    A valid event always has a time.  A (day, route) that vanishes from silver
    stays in gold.
    """
    if days == []:
        return None
    fact = storage.read_stored(spark, cfg, SILVER) if days is not None else storage.read_table(spark, cfg, SILVER)
    if days is not None:
        # Partition pruning: only the changed days are read.
        fact = fact.filter(F.col("event_date").isin([d for d in days if d is not None]))
    version = storage.upsert_table(
        kpi.kpi_daily(fact), cfg, GOLD, ["kpi_date", "route_id"],
        ["trip_update_cnt", "avg_delay_sec", "p95_delay_sec"],
    )
    if version is not None:
        storage.log_commit(spark, cfg, GOLD, version, "MERGE", None)
    return version


def run_pending_gold(spark: SparkSession, cfg: LakeConfig) -> int | None:
    """KPIs of the days that incremental silver has noted; a note goes once gold holds its day."""
    at = storage.snapshot(spark, cfg, CHANGED)
    days = [r[0] for r in storage.read_stored(spark, cfg, CHANGED, at).distinct().collect()]
    version = run_gold(spark, cfg, sorted(days, key=lambda d: (d is None, d or date.min)))
    storage.drop_loads(spark, cfg, CHANGED, at.loads)
    return version


def enriched_kpi(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """The reporting view."""
    return kpi.enrich(storage.read_table(spark, cfg, GOLD), storage.read_table(spark, cfg, DIM))
