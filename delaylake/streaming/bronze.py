"""Messages to bronze in micro-batches, with metrics per batch."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from delaylake import storage
from delaylake import fixed_values as fv
from delaylake.config import LakeConfig
from delaylake.operators.combine import union_all
from delaylake.operators.facts import route_breakdown
from delaylake.sources.messages import message_routes, shape_messages

HUB = "bronze.eventhub_gtfs_raw"


def start(
    writer, checkpoint: str, trigger: str = "30 seconds", available_now: bool = False
) -> StreamingQuery:
    """Start a stream writer on a fixed interval, or once through what is available."""
    timed = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return timed.option("checkpointLocation", checkpoint).start()


def batch_metrics(batch: DataFrame, load_id: str, latency_ms: float) -> DataFrame:
    """Run-log rows of one micro-batch: messages by route, and the totals."""
    by_route = route_breakdown(message_routes(batch), fv.UNKNOWN_ROUTE)
    log = by_route.select(
        F.lit("stream_route_ingest").alias("job"), F.lit(load_id).alias("run_id"),
        F.current_timestamp().alias("started_at"), F.lit("TERMINATED").alias("life_cycle"),
        F.lit("SUCCESS").alias("result"), F.col("document_count").alias("rows"),
        F.lit(None).cast("double").alias("latency_ms"), F.col("route_id").alias("detail"),
    )
    total = by_route.agg(
        F.coalesce(F.sum("document_count"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("routes"),
    ).select(
        F.lit("stream_batch_complete").alias("job"), F.lit(load_id).alias("run_id"),
        F.current_timestamp().alias("started_at"), F.lit("TERMINATED").alias("life_cycle"),
        F.lit("SUCCESS").alias("result"), "rows", F.lit(round(latency_ms, 1)).alias("latency_ms"),
        F.to_json(F.struct(F.col("routes").alias("distinct_routes"))).alias("detail"),
    )
    return union_all([log, total])


def start_bronze_stream(
    messages: DataFrame, cfg: LakeConfig, trigger: str = "30 seconds", available_now: bool = False,
    flow: str = "hub_to_bronze",
) -> StreamingQuery:
    """Append each micro-batch of messages as one load; a replayed batch adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        t0 = time.time()
        load_id = f"{flow}-b{batch_id:09d}"
        storage.append(batch, cfg, HUB, load_id)
        # Metrics come from the load as stored: no second read of the source.
        stored = storage.read_load(batch.sparkSession, cfg, HUB, load_id)
        storage.log_runs(batch_metrics(stored, load_id, (time.time() - t0) * 1000), cfg, load_id)

    writer = shape_messages(messages).writeStream.foreachBatch(write).outputMode("append")
    return start(writer, cfg.checkpoint(flow), trigger, available_now)
