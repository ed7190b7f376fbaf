"""Exact dedup by a Golomb-coded fingerprint exchange.

Blocks of rows (the partitions in which texts are read) hash their texts and send every owner the sorted, distinct fingerprints of its range,
as Golomb-Rice coded differences. Owners answer each block with a bitmap over its list: which of them occur again.
Only rows behind set bits are suspects; their texts are shuffled and compared byte for byte.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm.shared import col, cut
from delaylake.llm.words import chunks, mix

SPACES = re.compile(r"[\x20\x09-\x0D]+")
PER_OWNER = 1 << 20
PRINTS = "id long, print long, sha string, block int"
LISTS = "owner int, block int, low long, n int, shift int, coded binary, twice binary"


def rice_encode(values: np.ndarray, shift: int) -> bytes:
    """Non-negative values: quotients by 2**shift in unary, then all remainders in `shift` bits each."""
    quotient = (values >> np.uint64(shift)).astype(np.int64)
    stops = np.cumsum(quotient + 1) - 1
    unary = np.ones(int(stops[-1]) + 1 if len(stops) else 0, np.uint8)
    unary[stops] = 0
    bits = ((values[:, None] >> np.arange(shift, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
    return np.packbits(np.concatenate([unary, bits])).tobytes()


def rice_decode(coded: bytes, n: int, shift: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(coded, np.uint8))
    stops = np.flatnonzero(bits == 0)[:n]
    quotient = np.diff(stops, prepend=-1) - 1
    low = bits[stops[-1] + 1 : stops[-1] + 1 + n * shift].reshape(n, shift).astype(np.uint64) if n else np.zeros((0, shift), np.uint64)
    return (quotient.astype(np.uint64) << np.uint64(shift)) + (low << np.arange(shift, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def golomb_shift(n: int, span: int) -> int:
    """The power of two nearest below the mean difference."""
    return max(0, (span // max(1, n)).bit_length() - 1)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(id, text) to (id, print, sha, block): SHA-256 of the normalised text, 62 mixed bits of it, and the block the row lies in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            sha = [hashlib.sha256(SPACES.sub(" ", t).encode()).digest() if t else hashlib.sha256().digest() for t in batch.column("text").to_pylist()]
            prints = mix(np.frombuffer(b"".join(s[:8] for s in sha), np.uint64)) >> np.uint64(2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(prints.astype(np.int64)), pa.array([s.hex() for s in sha], pa.string())], ["id", "print", "sha"]
            )

    return docs.mapInArrow(run, "id long, print long, sha string").withColumn("block", F.spark_partition_id())


def owner_of(prints: np.ndarray, n_owners: int) -> np.ndarray:
    """Owners hold equal ranges of the 62 bits."""
    return ((prints >> np.uint64(30)) * np.uint64(n_owners) >> np.uint64(32)).astype(np.int64)


def send(prints: DataFrame, n_owners: int) -> DataFrame:
    """Of each block, one list per owner; `twice` marks fingerprints that occur more than once inside the block."""

    def encode(rows: pa.Table) -> pa.Table:
        values, count = np.unique(rows.column("print").to_numpy().astype(np.uint64), return_counts=True)
        owner = owner_of(values, n_owners)
        out: list[list] = [[] for _ in range(7)]
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(values)], strict=True):
            part = values[a:b]
            gaps = np.diff(part)
            shift = golomb_shift(len(gaps), int(part[-1] - part[0]))
            row = (int(owner[a]), rows.column("block")[0].as_py(), int(part[0]), len(part), shift, rice_encode(gaps, shift), np.packbits(count[a:b] > 1).tobytes())
            for to, x in zip(out, row, strict=True):
                to.append(x)
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table({n: pa.array(x, t) for n, x, t in zip(("owner", "block", "low", "n", "shift", "coded", "twice"), out, kinds, strict=True)})

    return prints.select("block", "print").groupBy("block").applyInArrow(encode, LISTS)


def decode(row: dict) -> np.ndarray:
    gaps = rice_decode(row["coded"], row["n"] - 1, row["shift"])
    return np.concatenate([[np.uint64(row["low"])], np.uint64(row["low"]) + np.cumsum(gaps, dtype=np.uint64)])


def answer(lists: DataFrame) -> DataFrame:
    """Each owner's answers: (block, owner, bitmap) over the block's list. Lists without a repeated fingerprint get none."""

    def mark(held: pa.Table) -> pa.Table:
        rows = held.to_pylist()
        values = [decode(r) for r in rows]
        _, place, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        again, at, out = count[place] > 1, 0, []
        for r, v in zip(rows, values, strict=True):
            bits = again[at : at + len(v)] | (np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=len(v)) > 0)
            at += len(v)
            if bits.any():
                out.append((r["block"], r["owner"], np.packbits(bits).tobytes()))
        return pa.table({"block": pa.array([x[0] for x in out], pa.int32()), "owner": pa.array([x[1] for x in out], pa.int32()), "bitmap": pa.array([x[2] for x in out], pa.binary())})

    return lists.groupBy("owner").applyInArrow(mark, "block int, owner int, bitmap binary")


def suspects(prints: DataFrame, lists: DataFrame, answers: DataFrame) -> DataFrame:
    """(block, print) behind the set bits: each block's own list, read with the bitmap that came back."""
    both = lists.select("block", "owner", "low", "n", "shift", "coded").join(answers, ["block", "owner"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values = decode(row)
                values = values[np.unpackbits(np.frombuffer(row["bitmap"], np.uint8), count=len(values)) > 0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), row["block"], np.int32)), pa.array(values.astype(np.int64))], ["block", "print"])

    return both.mapInArrow(run, "block int, print long")


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", per_owner: int = PER_OWNER) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, sha (of the normalised text, lower-case hexadecimal).

    Texts are equal if identical after each run of ASCII white space is replaced by one space; null counts as empty. Of equal texts the smallest
    id stays; rows without id come last, so they stay only among themselves (keep_id null, kept true). Of repeated rows of the smallest id all are
    kept. An empty table gives an empty result.
    """
    docs = docs.select(col(doc_id).cast("long").alias("id"), F.coalesce(col(text), F.lit("")).alias("text"))
    # Written once: blocks stay what they were when their lists were sent.
    prints = cut(fingerprints(docs))
    n_owners = max(1, -(-prints.count() // per_owner))
    lists = cut(send(prints, n_owners))
    marked = suspects(prints, lists, answer(lists))
    held = cut(prints.join(marked, ["block", "print"], "left_semi").select("id", "print", "sha"))
    # Byte for byte: the normalised texts of suspects are the keys of the groups.
    normal = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    texts = docs.join(held.select("id", "print", "sha").distinct(), F.col("text").isNotNull() & docs["id"].eqNullSafe(held["id"])).select(docs["id"], "print", "sha", normal.alias("normal"))
    groups = texts.filter(F.sha2("normal", 256) == F.col("sha")).groupBy("print", "sha", "normal").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.filter("group_size > 1").select("sha", "keep_id", "group_size")
    twin = prints.select("id", "sha").join(groups, "sha", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return twin.select(
        "id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"), F.col("id").eqNullSafe(keep).alias("kept"), "sha"
    )
