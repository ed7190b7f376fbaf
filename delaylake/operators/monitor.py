"""Freshness, run health, recent operations and the overall report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from delaylake import fixed_values as fv
from delaylake.operators.combine import union_all
from delaylake.operators.quality import quality_status
from delaylake.operators.ranking import last_n_per


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def extent(df: DataFrame, ts_col: str) -> DataFrame:
    """Row count, earliest and latest value of a time column."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(ts_col).alias("earliest"),
        F.max(ts_col).alias("latest"),
    )


def _age_hours(latest: Column, is_date: bool, now: Column) -> Column:
    if is_date:
        return F.datediff(now.cast("date"), latest) * F.lit(24.0)
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(latest.cast("timestamp"))
    return micros / F.lit(3_600_000_000.0)


def freshness(tables: Iterable[tuple[str, DataFrame, str, int]], now: Column) -> DataFrame:
    """Per table: rows, newest value, age in hours against its limit, and status.

    ``tables`` lists (name, frame, time column, limit in hours).  Timestamps give
    fractional hours, dates whole days; an empty table has the sentinel age.
    """
    def top(df: DataFrame, ts_col: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count"), F.max(ts_col).alias("latest"))

    return freshness_of([(name, top(df, ts_col), limit) for name, df, ts_col, limit in tables], now)


def freshness_of(extents: Iterable[tuple[str, DataFrame, int]], now: Column) -> DataFrame:
    """The same from (name, one row of row_count and latest, limit in hours), wherever the rows come from."""
    def one(name: str, top: DataFrame, limit: int) -> DataFrame:
        is_date = isinstance(top.schema["latest"].dataType, DateType)
        exact = F.coalesce(_age_hours(F.col("latest"), is_date, now), F.lit(fv.EMPTY_AGE_HOURS))
        latest_text = F.substring(F.col("latest").cast("string"), 1, 19)
        return top.select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.coalesce(latest_text, F.lit("EMPTY")).alias("latest"),
            F.round(exact, 1).alias("age_hours"),
            F.lit(limit).alias("threshold_hours"),
            F.when(exact > limit, "STALE").otherwise("OK").alias("status"),
        )

    return union_all([one(*t) for t in extents])


def overlong_runs(run_log: DataFrame, limit_ms: float = fv.RUN_LIMIT_MS) -> DataFrame:
    """Finished runs that took longer than a job may."""
    return run_log.filter(F.col("latency_ms") > limit_ms)


def run_health(run_log: DataFrame, jobs: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Runs of each listed job by outcome over the last hours, and a status."""
    started = F.col("started_at") >= now.cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")
    counts = run_log.filter(started).groupBy("job").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("result") == "SUCCESS").alias("success"),
        F.count_if(F.col("result") == "FAILED").alias("failed"),
        F.count_if(F.col("life_cycle") == "RUNNING").alias("running"),
        F.count_if(F.col("result") == "CANCELED").alias("cancelled"),
    )
    measures = ("runs", "success", "failed", "running", "cancelled")
    filled = jobs.select("job").join(counts, "job", "left").select(
        "job", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in measures]
    )
    status = (
        F.when(F.col("failed") > 0, "FAILURES")
        .when(F.col("runs") == 0, "NO RUNS")
        .otherwise("HEALTHY")
    )
    return filled.withColumn("status", status)


def recent_ops(commit_logs: Mapping[str, DataFrame] | DataFrame, n: int = 5, order: str = "version") -> DataFrame:
    """The last ``n`` operations of each table, from one log or one per table."""
    if isinstance(commit_logs, DataFrame):
        log = commit_logs
    else:
        log = union_all([df.withColumn("table_name", F.lit(t)) for t, df in commit_logs.items()])
    # Loads and versions of one table are numbered apart; time orders both.
    return last_n_per(log, "table_name", order, n)


def health_report(fresh: DataFrame, runs: DataFrame, profile: DataFrame) -> DataFrame:
    """One row: fresh tables, healthy jobs, quality, overall status and reasons."""
    tables = fresh.agg(
        F.count(F.lit(1)).alias("tables"), F.count_if(F.col("status") == "STALE").alias("stale_tables")
    )
    jobs = runs.agg(F.count(F.lit(1)).alias("jobs"), F.count_if(F.col("failed") > 0).alias("failed_jobs"))
    quality = profile.select("valid_pct", "total_events", "distinct_routes")
    checked = quality_status(profile).select(F.col("status").alias("quality_status"))
    # Four one-row aggregates side by side, without a join.
    parts = union_all([tables, jobs, quality, checked], allow_missing=True)
    row = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    pct = F.coalesce(F.col("valid_pct").cast("string"), F.lit("no data"))
    reasons = F.concat_ws(
        ", ",
        F.when(F.col("stale_tables") > 0, F.concat(F.col("stale_tables").cast("string"), F.lit(" stale table(s)"))),
        F.when(F.col("failed_jobs") > 0, F.concat(F.col("failed_jobs").cast("string"), F.lit(" failed job(s)"))),
        F.when(F.col("quality_status") == "LOW", F.concat(F.lit("quality at "), pct, F.lit("%"))),
        F.when(F.col("quality_status") == "EMPTY", F.lit("no silver events")),
    )
    return row.select(
        "tables", (F.col("tables") - F.col("stale_tables")).alias("fresh_tables"),
        "jobs", (F.col("jobs") - F.col("failed_jobs")).alias("healthy_jobs"),
        "valid_pct", "total_events", "distinct_routes",
        F.when(reasons == "", "HEALTHY").otherwise("NEEDS ATTENTION").alias("overall_status"),
        reasons.alias("reasons"),
    )
