"""Hub messages in the Kafka column layout."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake import schemas
from delaylake.functions import parse_json, parse_ts


def read_messages(
    spark: SparkSession, options: Mapping[str, str], starting: str = "earliest"
) -> DataFrame:
    """Message stream from a broker; needs Spark's Kafka package on the class path."""
    return spark.readStream.format("kafka").options(**options).option("startingOffsets", starting).load()


def send_messages(values: DataFrame, options: Mapping[str, str], topic: str) -> None:
    """Send message values to a broker topic, in parallel from the executors."""
    values.write.format("kafka").options(**options).option("topic", topic).save()


def shape_messages(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """Bronze columns of a message frame: offset twice, arrival time, text, ingest time."""
    return messages.select(
        F.col("offset").cast("bigint").alias("sequence_number"),
        F.col("offset").cast("string").alias("offset"),
        F.col("timestamp").alias("enqueued_time"),
        F.decode("value", "UTF-8").alias("payload"),
        (F.current_timestamp() if now is None else now).alias("bronze_ingest_ts"),
    )


def parse_hub(raw: DataFrame) -> DataFrame:
    """Event columns from the JSON payload, which is parsed once per row.

    A malformed payload or field gives NULL instead of an error.
    """
    doc = raw.select(parse_json("payload", schemas.MESSAGE_TEXT).alias("m"))
    return doc.select(
        F.col("m.id").alias("id"),
        F.col("m.route_id").alias("route_id"),
        F.col("m.payload.trip_id").alias("trip_id"),
        F.col("m.payload.trip_update_timestamp").try_cast("bigint").alias("trip_update_timestamp"),
        F.col("m.payload.first_stop_delay_sec").try_cast("int").alias("first_stop_delay_sec"),
        F.col("m.metadata.ingest_batch_id").alias("ingest_batch_id"),
        parse_ts("m.metadata.ingested_at").alias("ingested_at"),
    )


def message_routes(raw: DataFrame) -> DataFrame:
    """Only the route of each message, for per-batch metrics."""
    return raw.select(F.get_json_object("payload", "$.route_id").alias("route_id"))
