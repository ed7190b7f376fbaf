"""Documents: from feed entities to envelopes, and from stored JSON to bronze rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delaylake import fixed_values as fv
from delaylake import schemas
from delaylake.functions import doc_id, first_stop_delay, is_stream_route, parse_json, parse_ts, to_iso


def trip_docs(
    entities: DataFrame,
    batch_id: Column | str,
    ingested_at: Column,
    mode: str = "letter_to_stream",
    stream_ids: Iterable[str] = (),
) -> DataFrame:
    """Canonical documents of the feed entities that carry a trip update.

    Missing or empty route and trip become "UNKNOWN" and ""; a zero feed time
    becomes NULL in the payload while the id still hashes the zero.
    """
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    update = F.col("trip_update")
    fields = entities.filter(update.isNotNull()).select(
        F.coalesce("id", F.lit("")).alias("_entity"),
        F.coalesce(F.nullif(update["trip"]["route_id"], F.lit("")), F.lit(fv.UNKNOWN_ROUTE)).alias("_route"),
        F.coalesce(update["trip"]["trip_id"], F.lit("")).alias("_trip"),
        F.coalesce(update["timestamp"], F.lit(0)).alias("_epoch"),
        first_stop_delay(update["stop_time_update"]).alias("_delay"),
        batch.alias("_batch"),
        to_iso(ingested_at).alias("_ingested"),
    ).withColumn("_stream", is_stream_route("_route", mode, stream_ids))
    stream = F.col("_stream")
    metadata = F.struct(
        F.lit(fv.SCHEMA_VERSION).alias("schema_version"),
        F.lit(fv.DEFAULT_SOURCE).alias("source_system"),
        F.lit(fv.EVENT_TYPE).alias("event_type"),
        F.col("_batch").alias("ingest_batch_id"),
        F.col("_ingested").alias("ingested_at"),
        F.when(stream, "stream").otherwise("batch").alias("segment"),
        F.lit(mode).alias("segment_mode"),
        F.when(stream, fv.CONTAINER_STREAM).otherwise(fv.CONTAINER_BATCH).alias("cosmos_container"),
        stream.alias("emit_to_event_hub"),
    )
    payload = F.struct(
        F.col("_entity").alias("feed_entity_id"),
        F.col("_trip").alias("trip_id"),
        F.nullif(F.col("_epoch"), F.lit(0).cast("bigint")).alias("trip_update_timestamp"),
        F.col("_delay").alias("first_stop_delay_sec"),
    )
    return fields.select(
        doc_id("_trip", "_epoch", "_entity").alias("id"),
        F.col("_route").alias("route_id"),
        metadata.alias("metadata"),
        payload.alias("payload"),
    )


def route_docs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(batch, stream) documents by segment; both keyed by (id, route_id) downstream."""
    segment = F.col("metadata.segment")
    return docs.filter(segment == "batch"), docs.filter(segment == "stream")


def to_messages(docs: DataFrame) -> DataFrame:
    """Documents as JSON message values."""
    return docs.select(F.to_json(F.struct("*")).alias("value"))


def parse_docs(df: DataFrame, schema: StructType = schemas.STORED_DOC, col: str = "value") -> DataFrame:
    """JSON text to typed columns; malformed text gives a row of NULLs."""
    return df.select(parse_json(col, schema).alias("d")).select("d.*")


def incremental_slice(
    df: DataFrame, last_ts: int | Column | None, ts_col: str = "_ts", overlap_sec: int = 0
) -> DataFrame:
    """Rows above the stored mark; everything when there is none.

    The mark has whole seconds, so documents of the same second that arrive later
    are missed; ``overlap_sec`` reads that far back and leaves the copies to the
    dedup by document id.
    """
    if last_ts is None or (isinstance(last_ts, int) and last_ts <= 0):
        return df
    return df.filter(F.col(ts_col) > (last_ts if isinstance(last_ts, Column) else F.lit(last_ts)) - overlap_sec)


def flatten_docs(docs: DataFrame, now: Column | None = None) -> DataFrame:
    """Bronze rows from documents of either shape: envelope first, then flat fields."""
    def either(nested: str, flat: str | None = None) -> Column:
        return F.coalesce(F.col(nested), F.col(flat or nested.split(".")[1]))

    return docs.select(
        "id",
        "route_id",
        F.coalesce("metadata.source_system", "source", F.lit(fv.DEFAULT_SOURCE)).alias("source"),
        either("payload.feed_entity_id").alias("feed_entity_id"),
        either("payload.trip_id").alias("trip_id"),
        either("payload.trip_update_timestamp").alias("trip_update_timestamp"),
        either("payload.first_stop_delay_sec").alias("first_stop_delay_sec"),
        either("metadata.ingest_batch_id").alias("ingest_batch_id"),
        F.coalesce(parse_ts("metadata.ingested_at"), parse_ts("ingested_at")).alias("ingested_at"),
        (F.current_timestamp() if now is None else now).alias("lake_ingest_ts"),
    )
