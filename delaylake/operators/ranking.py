"""Rank-based selection: newest per key, newest overall, ordered reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylake import fixed_values as fv
from delaylake.functions import event_time


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    # Catalyst turns "rank below a constant" into a WindowGroupLimit on the map
    # side, so a task sends at most ``limit`` rows per key into the shuffle and a
    # hot key (or the NULL key) cannot pile up in one reducer.
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= limit)


def total_order(df: DataFrame, used: Sequence[str] = ()) -> list[Column]:
    """The remaining columns as tie-break, so that a re-run task picks the same row."""
    return [F.desc(c) for c in df.columns if c not in used]


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order_by``.  NULL keys form one group."""
    return _ranked(df, keys, order_by, 1).drop("_rn")


def _freshest(ingested: str, source_col: str, *tie_break: Column) -> list[Column]:
    priority = F.when(F.col(source_col) == fv.TAG_BATCH, 0).otherwise(1)
    return [F.desc(ingested), priority.asc(), *[c.desc() for c in tie_break]]


def dedup_latest(unioned: DataFrame, source_col: str = "_source") -> DataFrame:
    """Freshest ingestion per document id; the batch path wins ties; NULL times last."""
    names = ("route_id", "trip_id", "first_stop_delay_sec", "ingest_batch_id")
    time = event_time("trip_update_timestamp", "ingested_at")
    order = _freshest("ingested_at", source_col, *[F.col(c) for c in names], time)
    return keep_first(unioned, ["id"], order)


def dedup_stored(rows: DataFrame) -> DataFrame:
    """The same choice among rows in the stored silver shape.

    Choosing the first of a total order is associative: ranking new rows against
    the stored winner equals ranking all rows ever loaded.
    """
    names = ("route_id", "trip_id", "delay_sec", "ingest_batch_id", "event_ts")
    order = _freshest("_ingested_at", "_source", *[F.col(c) for c in names])
    return keep_first(rows, ["event_sk"], order)


def latest_per_route(ref: DataFrame) -> DataFrame:
    """Newest snapshot of each route, so a route dropped from a later file survives."""
    order = [F.desc("snapshot_date"), F.desc("ingested_at")]
    order += total_order(ref, ("route_id", "snapshot_date", "ingested_at"))
    return keep_first(ref, ["route_id"], order)


def global_latest(ref: DataFrame) -> DataFrame:
    """Rows of the newest snapshot over all routes."""
    newest = ref.agg(F.max("snapshot_date").alias("snapshot_date"))
    # One row on the right: a fixed-size broadcast.
    return ref.join(F.broadcast(newest), "snapshot_date", "left_semi")


def last_n_per(df: DataFrame, key: str, ts: str, n: int) -> DataFrame:
    """The newest ``n`` rows of each key."""
    order = [F.desc(ts)] + total_order(df, (key, ts))
    return _ranked(df, [key], order, n).drop("_rn")


def newest(df: DataFrame, ts_col: str, n: int = 20) -> DataFrame:
    """The newest ``n`` rows; every other column breaks ties."""
    return df.orderBy(F.desc(ts_col), *total_order(df, (ts_col,))).limit(n)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def sorted_desc(df: DataFrame, col: str) -> DataFrame:
    """Rows by one measure, largest first."""
    return df.orderBy(F.desc(col))


def report(df: DataFrame, *order: Column | str) -> DataFrame:
    """Order rows at the edge of a report; never used inside a plan."""
    return df.orderBy(*order)
