"""Unions by column name."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake import fixed_values as fv

EVENT_COLUMNS = (
    "id", "route_id", "trip_id", "trip_update_timestamp", "first_stop_delay_sec",
    "ingest_batch_id", "ingested_at",
)


def tag_source(df: DataFrame, tag: str, name: str = "_source") -> DataFrame:
    """The event columns with a constant source tag."""
    return df.select(*EVENT_COLUMNS, F.lit(tag).alias(name))


def union_sources(batch: DataFrame, hub: DataFrame) -> DataFrame:
    """Rows of both ingestion paths; ``hub`` is already parsed."""
    return tag_source(batch, fv.TAG_BATCH).unionByName(tag_source(hub, fv.TAG_HUB))


def union_all(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Fold a list of frames into one by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
