"""Feed entities to document stores, documents above the mark to bronze, the route reference."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from delaylake import storage
from delaylake.config import LakeConfig
from delaylake.operators.combine import union_all
from delaylake.operators.facts import route_breakdown
from delaylake.operators.ranking import keep_first
from delaylake.operators.upsert import append_if_absent
from delaylake.sources.documents import (
    flatten_docs,
    incremental_slice,
    parse_docs,
    route_docs,
    trip_docs,
)
from delaylake.sources.reference import route_snapshot

STORES = {"batch": "docs.gtfs_rt_batch", "stream": "docs.gtfs_rt_stream"}
EVENTS = "bronze.gtfs_rt_events"
REFERENCE = "bronze.dim_route_ref"
SENT = "docs.sent_batches"


@dataclass(frozen=True)
class LoadResult:
    rows: int
    mark_from: int
    mark_to: int


def ingest_cycle(
    spark: SparkSession,
    cfg: LakeConfig,
    entities: DataFrame,
    batch_id: str,
    now: Column | None = None,
    mode: str = "letter_to_stream",
    stream_ids: Iterable[str] = (),
    send: Callable[[DataFrame], None] | None = None,
) -> dict[str, int]:
    """One poll of the feed: documents into the store of their segment, streamed ones also sent.

    A store gains one load per poll; the upsert by (id, route_id) happens when the
    store is read.  One instant holds for the whole poll.  ``send`` takes the message values, read from the
    stored load; a batch counts as sent once ``send`` has returned.  Repeating a batch id stores nothing, and sends
    only what was stored and not sent: at least once, with ids that make a second arrival harmless.  Returns the
    documents added per store.
    """
    t0 = time.time()
    now = storage.instant() if now is None else now
    with storage.failures_logged(spark, cfg, "ingest_cycle", batch_id):
        docs = trip_docs(entities, batch_id, now, mode, stream_ids)
        counts = {}
        for segment, part in zip(("batch", "stream"), route_docs(docs), strict=True):
            counts[segment] = _store(spark, cfg, STORES[segment], part, batch_id, now)
        if send is not None:
            _send_stored(spark, cfg, batch_id, now, send)
    total = sum(counts.values())
    detail = json.dumps({**counts, "segment_mode": mode})
    latency = round((time.time() - t0) * 1000, 1)
    storage.log_runs(
        storage.run_row(spark, "ingest_cycle", batch_id, now, "SUCCESS", total, latency, detail), cfg, batch_id
    )
    return counts


def _send_stored(
    spark: SparkSession, cfg: LakeConfig, batch_id: str, now: Column, send: Callable[[DataFrame], None]
) -> None:
    """Hand over the stored messages of a batch unless that was done, then note it."""
    store = STORES["stream"]
    if storage.has_load(spark, cfg, SENT, batch_id) or not storage.has_load(spark, cfg, store, batch_id):
        return
    values = storage.read_load(spark, cfg, store, batch_id).select("value")
    if not values.isEmpty():
        send(values)
    note = spark.range(1).select(F.lit(batch_id).alias("batch_id"), now.cast("timestamp").alias("sent_at"))
    storage.append(note, cfg, SENT, batch_id)


def _store(spark: SparkSession, cfg: LakeConfig, store: str, part: DataFrame, batch_id: str, now: Column) -> int:
    """Documents that this call added to a store: none if the batch was there."""
    if storage.has_load(spark, cfg, store, batch_id):
        return 0
    seen = Observation()
    stored = part.select(
        "id", "route_id", F.to_json(F.struct("*")).alias("value"), F.unix_seconds(now.cast("timestamp")).alias("_ts")
    ).observe(seen, F.count(F.lit(1)).alias("rows"))
    placed = storage.place_load(spark, cfg, store, storage.stage_load(stored, cfg, store), batch_id)
    return seen.get["rows"] if placed else 0


def stored_documents(spark: SparkSession, cfg: LakeConfig, segment: str = "batch", above: int | None = None) -> DataFrame:
    """Documents of a store, the latest of each (id, route_id).

    ``above`` reads only those written after a mark: the newest above it is the newest of all.
    """
    rows = storage.read_table(spark, cfg, STORES[segment])
    if above is not None:
        rows = rows.filter(F.col("_ts") > above)
    return keep_first(rows, ["id", "route_id"], [F.desc("_ts"), F.desc("value")])


def _finish_interrupted(spark: SparkSession, cfg: LakeConfig, key: str, mark: int, now: Column) -> int:
    """A load in place whose mark was not moved: move it instead of loading twice."""
    prefix = f"{key}-{mark}-"
    ends = [int(i[len(prefix):]) for i in storage.load_ids(spark, cfg, EVENTS) if i.startswith(prefix)]
    if not ends:
        return mark
    storage.write_mark(spark, cfg, key, max(ends), now)
    return _finish_interrupted(spark, cfg, key, max(ends), now)


def load_documents(
    spark: SparkSession,
    cfg: LakeConfig,
    docs: DataFrame,
    key: str = "documents",
    now: Column | None = None,
    overlap_sec: int = 0,
) -> LoadResult:
    """Append the documents (``value`` JSON, ``_ts`` seconds) above the stored mark.

    Rows and the new mark are observed while writing; the load is then put in
    place under the name of both marks and the mark is moved.  Documents without ``_ts`` belong to no
    load; they are counted in the run log.
    """
    now = storage.instant() if now is None else now
    with storage.failures_logged(spark, cfg, "batch_cycle_complete", key):
        return _load_documents(spark, cfg, docs, key, now, overlap_sec)


def _load_documents(
    spark: SparkSession, cfg: LakeConfig, docs: DataFrame, key: str, now: Column, overlap_sec: int
) -> LoadResult:
    t0 = time.time()
    mark = _finish_interrupted(spark, cfg, key, storage.read_mark(spark, cfg, key), now)
    seen, unmarked = Observation(), Observation()
    marked = docs.observe(unmarked, F.count_if(F.col("_ts").isNull()).alias("rows")).filter(F.col("_ts").isNotNull())
    fresh = incremental_slice(marked, mark, overlap_sec=overlap_sec).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.max("_ts").alias("mark")
    )
    staged = storage.stage_load(flatten_docs(parse_docs(fresh.select("value")), now), cfg, EVENTS)
    rows, new_mark = seen.get["rows"], seen.get["mark"]
    if without := unmarked.get["rows"]:
        storage.log_runs(storage.run_row(spark, "documents_without_mark", f"{key}-{mark}", now, "SUCCESS", without, None), cfg)
    if not rows or (new_mark is not None and new_mark <= mark):
        storage.drop_staged(spark, cfg, EVENTS, staged)
        skipped = storage.run_row(spark, "batch_cycle_skip", f"{key}-{mark}", now, "SUCCESS", 0, None,
                                  json.dumps({"reason": "no_new_documents", "watermark": mark}))
        storage.log_runs(skipped, cfg)
        return LoadResult(0, mark, mark)
    load_id = f"{key}-{mark}-{new_mark}"
    storage.place_load(spark, cfg, EVENTS, staged, load_id)
    storage.write_mark(spark, cfg, key, new_mark, now)
    _log_load(spark, cfg, load_id, rows, mark, new_mark, now, (time.time() - t0) * 1000)
    storage.log_commit(spark, cfg, EVENTS, storage.state(spark, cfg, EVENTS).version, "WRITE", rows)
    return LoadResult(rows, mark, new_mark)


def _log_load(
    spark: SparkSession, cfg: LakeConfig, load_id: str, rows: int, mark: int, new_mark: int,
    now: Column, latency_ms: float,
) -> None:
    loaded = storage.read_load(spark, cfg, EVENTS, load_id)
    by_route = route_breakdown(loaded).select(
        F.lit("batch_route_ingest").alias("job"), F.lit(load_id).alias("run_id"), now.alias("started_at"),
        F.lit("TERMINATED").alias("life_cycle"), F.lit("SUCCESS").alias("result"),
        F.col("document_count").alias("rows"), F.lit(None).cast("double").alias("latency_ms"),
        F.col("route_id").alias("detail"),
    )
    detail = json.dumps({"watermark_from": mark, "watermark_to": new_mark})
    total = storage.run_row(spark, "batch_cycle_complete", load_id, now, "SUCCESS", rows,
                            round(latency_ms, 1), detail)
    storage.log_runs(union_all([by_route, total]), cfg, load_id)


def load_reference(
    spark: SparkSession, cfg: LakeConfig, routes: DataFrame, snapshot_date: str, now: Column | None = None
) -> bool:
    """Append a reference snapshot unless its date is there; False when it was."""
    now = storage.instant() if now is None else now
    rows = route_snapshot(routes, snapshot_date, f"ref-{snapshot_date.replace('-', '')}", now)
    known = storage.read_table(spark, cfg, REFERENCE)
    return storage.append(append_if_absent(rows, known), cfg, REFERENCE, f"snapshot-{snapshot_date}")
