"""Silver facts, in the two variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylake import fixed_values as fv
from delaylake.functions import event_time, kpi_date, path_key, validity
from delaylake.operators.combine import union_sources
from delaylake.operators.ranking import dedup_latest


def _silver_columns() -> list[Column]:
    return [
        F.col("id").alias("event_sk"),
        F.col("route_id"),
        F.col("trip_id"),
        event_time("trip_update_timestamp", "ingested_at").alias("event_ts"),
        F.col("first_stop_delay_sec").alias("delay_sec"),
        F.col("ingest_batch_id"),
        validity("strict").alias("is_valid"),
    ]


def to_silver(events: DataFrame) -> DataFrame:
    """Event rows in the silver contract; the document id is the key."""
    return events.select(*_silver_columns())


def to_stored_silver(events: DataFrame) -> DataFrame:
    """The silver contract with its day and the columns a later load is ranked by."""
    time = event_time("trip_update_timestamp", "ingested_at")
    return events.select(
        *_silver_columns(),
        F.col("ingested_at").alias("_ingested_at"),
        "_source",
        kpi_date(time).alias("event_date"),
    )


def silver_fact(batch: DataFrame, hub: DataFrame) -> DataFrame:
    """Both paths united, one row per document, in the silver contract."""
    return to_silver(dedup_latest(union_sources(batch, hub)))


def _flow_rows(events: DataFrame, key_tag: str, source_system: str) -> DataFrame:
    return events.select(
        path_key("id", key_tag, "trip_update_timestamp").alias("event_sk"),
        "route_id",
        "trip_id",
        event_time("trip_update_timestamp", "ingested_at").alias("event_ts"),
        F.col("first_stop_delay_sec").alias("delay_sec"),
        "ingest_batch_id",
        validity("either").alias("is_valid"),
        F.lit(source_system).alias("source_system"),
    )


def silver_from_batch(events: DataFrame) -> DataFrame:
    """Declarative variant, batch path: no dedup, key carries the path."""
    return _flow_rows(events, fv.KEY_TAG_BATCH, fv.FLOW_TAG_BATCH)


def silver_from_hub(events: DataFrame) -> DataFrame:
    """Declarative variant, message path; ``events`` is already parsed."""
    return _flow_rows(events, fv.KEY_TAG_HUB, fv.FLOW_TAG_HUB)


def valid_only(fact: DataFrame) -> DataFrame:
    """Rows flagged valid."""
    return fact.filter(F.col("is_valid"))


def fact_by_route(fact: DataFrame) -> DataFrame:
    """Events, valid events, mean delay, first and last time per route."""
    return fact.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_valid").alias("valid_events"),
        F.avg("delay_sec").alias("avg_delay_sec"),
        F.min("event_ts").alias("earliest"),
        F.max("event_ts").alias("latest"),
    )


def route_breakdown(df: DataFrame, null_label: str | None = None) -> DataFrame:
    """Rows per route in a load or micro-batch."""
    route = F.col("route_id") if null_label is None else F.coalesce("route_id", F.lit(null_label))
    return df.groupBy(route.alias("route_id")).agg(F.count(F.lit(1)).alias("document_count"))
