"""The health report over the stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake import storage
from delaylake.config import TABLES, LakeConfig
from delaylake.operators import monitor, quality

# Jobs whose runs are watched.
JOBS = ("batch_cycle_complete", "stream_batch_complete", "ingest_cycle")


def table_freshness(spark: SparkSession, cfg: LakeConfig, now: Column | None = None) -> DataFrame:
    """Freshness of every table that has a staleness limit."""
    now = F.current_timestamp() if now is None else now
    watched = [t for t in TABLES.values() if t.stale_hours is not None]
    return monitor.freshness(
        [(t.name, storage.read_table(spark, cfg, t.name), t.ts_col, t.stale_hours) for t in watched], now
    )


def job_health(
    spark: SparkSession, cfg: LakeConfig, now: Column | None = None, jobs: Sequence[str] = JOBS
) -> DataFrame:
    """Outcomes of the watched jobs in the last 24 hours."""
    now = F.current_timestamp() if now is None else now
    listed = spark.createDataFrame([(j,) for j in jobs], "job string")
    return monitor.run_health(storage.read_table(spark, cfg, "ops.run_log"), listed, now)


def operations(spark: SparkSession, cfg: LakeConfig, n: int = 5) -> DataFrame:
    """Recent operations of the main tables."""
    return monitor.recent_ops(storage.read_table(spark, cfg, "ops.commit_log"), n, order="ts")


def report(spark: SparkSession, cfg: LakeConfig, now: Column | None = None) -> DataFrame:
    """Overall status with reasons."""
    profile = quality.quality_profile(storage.read_table(spark, cfg, "silver.fact_trip_delay_event"))
    return monitor.health_report(
        table_freshness(spark, cfg, now), job_health(spark, cfg, now), profile
    )
