"""Session set-up: what the engine needs from Spark, and nothing else."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings; safe to apply to a session somebody else created.
RUNTIME_CONF = {
    # Stored times are UTC; dates and hours are cut in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Shuffle sizes are left to AQE: coalescing, skew splits, runtime broadcast.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Times with statistics in the file footers, and counts and extremes read from there.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "delaylake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())
