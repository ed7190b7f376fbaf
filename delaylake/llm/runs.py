"""Runs of rows, written once in the shared folder, and an exchange that tells every run which of its values weigh enough over all runs.

A run sends each owner of a range of values the sorted, distinct values of that range as differences, with their weights. The owner
adds the weights up and answers with a bitmap over the list it was sent, so neither side ever holds the values of all runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm.shared import cut
from delaylake.llm.words import chunks

RUN_BYTES = 4 << 20
OWNER_VALUES = 2 << 20
HELD = "run long, held binary"


def write_runs(rows: DataFrame, text: str, limit: int = RUN_BYTES) -> DataFrame:
    """(run, held): the rows in Arrow blocks of about `limit` bytes of text; a longer text is a run of its own. Run numbers are unique."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in chunks(batches, text, limit):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["run", "held"])
            number += 1

    return cut(rows.mapInArrow(pack, HELD))


def read_run(held: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(held) as source:
        return source.read_next_batch()


def planes(values: np.ndarray) -> bytes:
    """64-bit values byte by byte: first all lowest bytes, so that what is always zero stands together and compresses away."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(held: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(held, np.uint8).reshape(8, -1).T).view("<u8").ravel()


Values = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]


def owners_for(n_values: int) -> int:
    return max(1, -(-n_values // OWNER_VALUES))


def owner_cuts(values: np.ndarray, n_owners: int, bits: int) -> tuple[np.ndarray, list[int]]:
    """The owner of each part of the sorted values, and where the parts begin and end."""
    span = np.uint64(-(-(1 << bits) // n_owners))
    owner = (values // span).astype(np.int64)
    begins = np.flatnonzero(np.diff(owner, prepend=-1))
    return owner[begins], [*begins.tolist(), len(values)]


def enough(runs: DataFrame, values: Values, n_owners: int, bits: int, least: int, crowd: int | None = None) -> DataFrame:
    """(run, marks): per run its owners' bitmaps over what `values` gives for it (sorted distinct uint64 below 2**bits, and weights).

    A bit is set if the weights of that value over all runs, each taken as 255 at most, add up to `least` (at most 255). Runs without a
    set bit have no row. `crowded` holds a second bitmap, of values that reach `crowd`, or null.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, held in zip(batch.column("run").to_pylist(), batch.column("held"), strict=True):
                v, w = values(read_run(held.as_py()))
                owner, at = owner_cuts(v, n_owners, bits)
                w = np.minimum(w, 255).astype(np.uint8)
                parts = list(zip(at[:-1], at[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(owner.astype(np.int32)), pa.array([run] * len(parts), pa.int64()),
                        pa.array([planes(np.diff(v[a:b], prepend=np.uint64(0))) for a, b in parts], pa.binary()),
                        pa.array([w[a:b].tobytes() for a, b in parts], pa.binary()),
                    ],
                    ["owner", "run", "gaps", "weights"],
                )

    def answer(lists: pa.Table) -> pa.Table:
        held = [np.cumsum(unplanes(g.as_py()), dtype=np.uint64) for g in lists.column("gaps")]
        weight = np.concatenate([np.frombuffer(w.as_py(), np.uint8) for w in lists.column("weights")])
        all_values = np.concatenate(held)
        order = np.argsort(all_values, kind="stable")
        new = np.flatnonzero(np.diff(all_values[order], prepend=all_values[order[0]] + np.uint64(1)))
        total = np.add.reduceat(weight[order].astype(np.int64), new)
        sums = np.empty(len(order), np.int64)
        sums[order] = np.repeat(total, np.diff(np.append(new, len(order))))
        ends = np.cumsum([len(h) for h in held])
        parts = [sums[e - len(h) : e] for h, e in zip(held, ends, strict=True)]
        told = [k for k, p in enumerate(parts) if p.max() >= least]
        bitmap = lambda x: np.packbits(x).tobytes() if x.any() else None
        return pa.table({
            "run": pa.array([lists.column("run")[k].as_py() for k in told], pa.int64()), "owner": pa.array([lists.column("owner")[k].as_py() for k in told], pa.int32()),
            "bitmap": pa.array([bitmap(parts[k] >= least) for k in told], pa.binary()),
            "crowded": pa.array([bitmap(parts[k] >= crowd) if crowd else None for k in told], pa.binary()),
        })

    lists = runs.mapInArrow(send, "owner int, run long, gaps binary, weights binary")
    answers = lists.groupBy("owner").applyInArrow(answer, "run long, owner int, bitmap binary, crowded binary")
    return answers.groupBy("run").agg(F.collect_list(F.struct("owner", "bitmap", "crowded")).alias("marks"))


def marked(v: np.ndarray, marks: list[dict], n_owners: int, bits: int, which: str = "bitmap") -> np.ndarray:
    """The answers of `enough` for one run as booleans over its sorted values."""
    owner, at = owner_cuts(v, n_owners, bits)
    place = {o: k for k, o in enumerate(owner.tolist())}
    out = np.zeros(len(v), bool)
    for m in marks or ():
        if m[which] is not None:
            a, b = at[place[m["owner"]]], at[place[m["owner"]] + 1]
            out[a:b] = np.unpackbits(np.frombuffer(m[which], np.uint8), count=b - a) > 0
    return out
