"""Route reference file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_routes_csv(spark: SparkSession, path: str) -> DataFrame:
    """The reference CSV: header row, all columns text, byte-order mark tolerated."""
    return spark.read.csv(path, header=True)


def route_snapshot(
    routes: DataFrame, snapshot_date: Column | str, batch_id: Column | str, now: Column
) -> DataFrame:
    """Snapshot rows that keep the full reference record as JSON."""
    day = F.lit(snapshot_date) if isinstance(snapshot_date, str) else snapshot_date
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    # NULL fields stay in the record.
    record = F.to_json(F.struct(*[F.col(c) for c in routes.columns]), {"ignoreNullFields": "false"})
    return routes.select(
        "route_id",
        day.cast("date").alias("snapshot_date"),
        record.alias("payload"),
        batch.alias("ingest_batch_id"),
        now.cast("timestamp").alias("ingested_at"),
    )
