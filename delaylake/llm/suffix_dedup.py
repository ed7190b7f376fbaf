"""Removal of repeated byte strings by column-wise construction of a collection's Burrows-Wheeler transform and common prefixes.

Consecutive windows that share a minimiser make one piece of text, so equal windows lie in pieces of one minimiser. Runs exchange their
minimisers first; pieces whose minimiser no other document has stay at home, the others meet in buckets of minimisers as packed blocks.
There equal pieces go whole but for those of the smallest document. What is left is a collection of different short strings: each round
inserts one symbol of every string, from its end to its beginning, into four columns (transform, common prefix, string, length) that are
read once and written once in order. Neighbours with a common prefix of a window are equal windows. The columns of a bucket are bounded
and kept in the task's memory as sequential arrays: files would have to lie in a folder of one machine.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm import runs as R
from delaylake.llm.shared import col, cut
from delaylake.llm.substring_dedup import sliding_min
from delaylake.llm.words import bytes_of, mix

SEED_BYTES = 24
BUCKET_BYTES = 4 << 20
CROWD = 20_000
NO_SYMBOL = 255  # never a byte of UTF-8
MULTIPLIER = np.array([0x5851F42D4C957F2D], np.uint64)  # an array, as it overflows on purpose
COLUMNS = np.dtype([("before", np.uint8), ("prefix", np.uint8), ("size", np.uint16), ("owner", np.uint32)])
BLOCKS = "bucket int, single boolean, run long, n_strings int, n int, size int, held binary"
MARKS = "run long, at array<int>, n array<int>"


def seed_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of each `width` consecutive bytes, by doubling."""
    part = data.astype(np.uint64) + np.uint64(1)
    have, out, factor, size = 0, None, MULTIPLIER, 1
    while True:
        if width & size:
            # What is there so far stands before this part.
            out = part if out is None else out[: max(0, len(part) - have)] * factor + part[have:][: len(out)]
            have += size
        if have == width:
            return mix(out)
        part = part[:-size] * factor + part[size:] if len(part) > size else part[:0]
        factor, size = factor * factor, 2 * size


def pieces(data: np.ndarray, bounds: np.ndarray, window: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, number of windows and minimiser of every piece: windows in a row that share a minimiser, as many at most as can share one place."""
    none = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    if len(data) < window:
        return none
    seed = min(SEED_BYTES, window)
    least = sliding_min(seed_hashes(data, seed), window - seed + 1)
    # Mixed once more: the smallest of many hashes is a small number.
    least = mix(least) >> np.uint64(64 - bits)
    whole = np.ones(len(least), bool)
    for k in range(1, window):
        at = bounds[1:-1] - k
        whole[at[(at >= 0) & (at < len(whole))]] = False
    spots = np.flatnonzero(whole)
    if not len(spots):
        return none
    new = np.ones(len(spots), bool)
    new[1:] = (np.diff(spots) > 1) | (least[spots[1:]] != least[spots[:-1]])
    first = np.flatnonzero(new)
    new[(np.arange(len(spots)) - np.repeat(first, np.diff(np.append(first, len(spots))))) % (window - seed + 1) == 0] = True
    first = np.flatnonzero(new)
    return spots[first], np.diff(np.append(first, len(spots))), least[spots[first]]


def by_value(minis: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct minimisers with their number of pieces, or 1 where all are of one document."""
    if not len(minis):
        return minis, np.zeros(0, np.int64)
    order = np.argsort(minis)
    m, d = minis[order], doc[order]
    new = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
    several = np.minimum.reduceat(d, new) != np.maximum.reduceat(d, new)
    return m[new], np.where(several, np.diff(np.append(new, len(m))), 1)


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def suspects(held: pa.RecordBatch, marks: list[dict], window: int, n_owners: int, bits: int, n_buckets: int, run: int) -> pa.RecordBatch:
    """Blocks for buckets: a run's pieces whose minimiser another document has too, equal strings once.

    Minimisers with a crowd of pieces would fill one bucket: their windows travel one by one, spread by their own bytes.
    """
    data, bounds = bytes_of(held.column("text"))
    begin, n, mini = pieces(data, bounds, window, bits)
    values = np.unique(mini)
    at = np.searchsorted(values, mini)
    keep = np.flatnonzero(R.marked(values, marks, n_owners, bits)[at])
    begin, n, mini, at = begin[keep], n[keep], mini[keep], at[keep]
    crowded = R.marked(values, marks, n_owners, bits, "crowded")[at]
    doc = column(held, "id")[np.searchsorted(bounds, begin, side="right") - 1]
    blocks = block_rows(data, begin[~crowded], n[~crowded], doc[~crowded], mini[~crowded], window, n_buckets, run, False)
    if crowded.any():
        size = n[crowded]
        lone = np.repeat(begin[crowded] - np.cumsum(size) + size, size) + np.arange(size.sum())
        blocks += block_rows(data, lone, np.ones(len(lone), np.int64), np.repeat(doc[crowded], size), seed_hashes(data, window)[lone], window, n_buckets, run, True)
    kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    names = ["bucket", "single", "run", "n_strings", "n", "size", "held"]
    return pa.RecordBatch.from_arrays([pa.array([b[k] for b in blocks], t) for k, t in enumerate(kinds)], names)


def alike(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each stretch of equal values; none is negative."""
    cuts = np.flatnonzero(np.diff(values, prepend=-1)).tolist()
    return list(itertools.pairwise([*cuts, len(values)])) if cuts else []


def block_rows(data: np.ndarray, begin: np.ndarray, n: np.ndarray, doc: np.ndarray, mini: np.ndarray, window: int, n_buckets: int, run: int, single: bool) -> list[tuple]:
    """Per bucket one row: lengths of its distinct strings, and of each piece its string, document and place, then the strings' bytes."""
    bucket = (mix(mini) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    begin, n, doc, bucket = begin[order], n[order], doc[order], bucket[order]
    text, stop = data.tobytes(), begin + n + window - 1
    out = []
    for a, b in alike(bucket):
        coded = pa.array([text[x:y] for x, y in zip(begin[a:b].tolist(), stop[a:b].tolist(), strict=True)], pa.binary()).dictionary_encode()
        strings = coded.dictionary.to_pylist()
        columns = [np.array([len(s) for s in strings], np.uint8).tobytes(), *(R.planes(x[a:b]) for x in (doc, begin)), R.planes(coded.indices.to_numpy().astype(np.int64))]
        held = b"".join([*columns, *strings])
        out.append((int(bucket[a]), single, run, len(strings), b - a, len(held), pa.compress(held, codec="zstd", asbytes=True)))
    return out


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low : high] for each pair, low < high, from minima of all powers of two."""
    size = high - low
    level = np.frexp(size.astype(np.float64))[1] - 1
    out = np.zeros(len(low), values.dtype)
    table, k = values, 0
    while True:
        here = np.flatnonzero(level == k)
        out[here] = np.minimum(table[low[here]], table[high[here] - (1 << k)])
        k += 1
        if not len(level) or k > level.max():
            return out
        table = np.minimum(table[: len(table) - (1 << (k - 1))], table[1 << (k - 1) :])


def insert_columns(data: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The sorted suffixes of all strings (string k is data[ends[k] - lengths[k] : ends[k]], of 254 bytes at most): symbol before the suffix,
    common prefix with the suffix before it, string and length. Ends of strings sort first, by number, and equal nothing.
    """
    m = len(ends)
    # All columns in one, read and written once a round: symbol before, common prefix, length and string.
    held = np.zeros(m, COLUMNS)
    held["before"] = np.where(lengths > 0, data[np.maximum(ends - 1, 0)], NO_SYMBOL)
    held["owner"] = np.arange(m)
    fresh = np.arange(m)  # where the suffixes of the last round stand
    for r in range(1, int(lengths.max(initial=0)) + 1):
        # A suffix c + x stands where x stands among all suffixes preceded by c: a stable sort by the symbol before.
        before, prefix = np.ascontiguousarray(held["before"]), np.ascontiguousarray(held["prefix"])
        n_known = int(np.count_nonzero(before != NO_SYMBOL))
        order = np.argsort(before, kind="stable")[:n_known]
        is_new = np.zeros(len(before), bool)
        is_new[fresh[before[fresh] != NO_SYMBOL]] = True
        new = np.flatnonzero(is_new[order])
        # Common prefixes change at new suffixes and at the one after each.
        change = np.zeros(n_known + 1, bool)
        change[new] = change[new + 1] = True
        touched = np.flatnonzero(change[1:n_known]) + 1
        touched = touched[before[order[touched]] == before[order[touched - 1]]]
        common = range_minima(prefix, order[touched - 1] + 1, order[touched] + 1) + 1
        string = held["owner"][order[new]]
        added = np.zeros(len(new), COLUMNS)
        added["before"] = np.where(lengths[string] > r, data[ends[string] - np.minimum(r + 1, lengths[string])], NO_SYMBOL)
        added["owner"], added["size"] = string, r
        fresh = m + new
        old = np.ones(m + n_known, bool)
        old[fresh] = False
        merged = np.empty(m + n_known, COLUMNS)
        merged.view(np.uint64)[fresh] = added.view(np.uint64)
        merged.view(np.uint64)[old] = held.view(np.uint64)
        held = merged
        held["prefix"][np.minimum(fresh + 1, len(held) - 1)] = 0
        held["prefix"][fresh] = 0
        held["prefix"][m + touched] = common
    return held["before"], held["prefix"], held["owner"], held["size"]


def shared_windows(strings: list[bytes], least: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of every window of a string that also lies in a string of a smaller document."""
    lengths = np.array([len(s) for s in strings], np.int64)
    _, prefix, owner, size = insert_columns(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(lengths), lengths)
    starts = np.flatnonzero(prefix < window)
    held = least[owner]
    lowest = np.repeat(np.minimum.reduceat(held, starts), np.diff(np.append(starts, len(held))))
    hit = np.flatnonzero((size >= window) & (lowest < held))
    return owner[hit].astype(np.int64), lengths[owner[hit]] - size[hit]


def minimisers(strings: list[bytes], window: int) -> np.ndarray:
    """The smallest seed hash of each string."""
    seed = min(SEED_BYTES, window)
    ends = np.cumsum([len(s) for s in strings])
    hashes = seed_hashes(np.frombuffer(b"".join(strings), np.uint8), seed)
    parts = np.stack([np.concatenate([[0], ends[:-1]]), ends - seed + 1], axis=1).ravel()
    return np.minimum.reduceat(np.append(hashes, np.uint64(0xFFFFFFFFFFFFFFFF)), parts)[::2]


def bucket_marks(rows: pa.Table, window: int) -> pa.Table:
    """One bucket's blocks to (run, at, n): windows that also start in a smaller document."""
    strings, code, doc, spot, run, known = [], [], [], [], [], 0
    for r, k, n, size, held in zip(*(rows.column(c).to_pylist() for c in ("run", "n_strings", "n", "size", "held")), strict=True):
        raw = pa.decompress(held, decompressed_size=size, codec="zstd", asbytes=True)
        lengths, at = np.frombuffer(raw, np.uint8, k), k
        for to in (doc, spot, code):
            to.append(R.unplanes(raw[at : at + 8 * n]).astype(np.int64))
            at += 8 * n
        code[-1] += known
        known += k
        ends = (at + np.cumsum(lengths)).tolist()
        strings += [raw[a:b] for a, b in zip([at, *ends[:-1]], ends, strict=True)]
        run.append(np.full(n, r, np.int64))
    coded = pa.array(strings, pa.binary()).dictionary_encode()
    strings = coded.dictionary.to_pylist()
    code, doc, spot, run = coded.indices.to_numpy()[np.concatenate(code)], np.concatenate(doc), np.concatenate(spot), np.concatenate(run)
    least = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(least, code, doc)
    count = np.array([len(s) for s in strings], np.int64) - window + 1
    later = np.flatnonzero(doc > least[code])
    found = [(run[later], spot[later], count[code[later]])]
    if not rows.column("single")[0].as_py():
        # Only minimisers with different strings can have windows that the comparison of whole strings missed.
        _, mini, same = np.unique(minimisers(strings, window), return_inverse=True, return_counts=True)
        mixed = np.flatnonzero(same[mini] > 1)
        which, offset = shared_windows([strings[k] for k in mixed], least[mixed], window)
        found.append(carried(mixed[which], offset, code, doc == least[code], run, spot))
    run, spot, count = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((spot, run))
    run, spot, count = run[order], spot[order], count[order]
    parts = alike(run)
    return pa.table({
        "run": pa.array([int(run[a]) for a, _ in parts], pa.int64()), "at": pa.array([spot[a:b].astype(np.int32) for a, b in parts], pa.list_(pa.int32())),
        "n": pa.array([count[a:b].astype(np.int32) for a, b in parts], pa.list_(pa.int32())),
    })


def carried(which: np.ndarray, offset: np.ndarray, code: np.ndarray, first: np.ndarray, run: np.ndarray, spot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marked windows of strings, as runs of windows at every place of the string in its smallest document."""
    order = np.lexsort((offset, which))
    which, offset = which[order], offset[order]
    new = np.ones(len(which), bool)
    new[1:] = (np.diff(which) != 0) | (np.diff(offset) != 1)
    begin = np.flatnonzero(new)
    which, offset, size = which[begin], offset[begin], np.diff(np.append(begin, len(which)))
    low, high = np.searchsorted(which, code), np.searchsorted(which, code, side="right")
    times = np.where(first, high - low, 0)
    place = np.repeat(np.arange(len(code)), times)
    span = np.repeat(low, times) + np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
    return run[place], spot[place] + offset[span], size[span]


def repeated_runs(held: DataFrame, total: int, window: int, bucket_bytes: int, crowd: int) -> DataFrame:
    """(run, at, n): of a run of rows, the windows from byte at to at + n - 1 that also start in a smaller document."""
    bits = max(8, min(60, total.bit_length() + 4))
    n_owners, n_buckets = R.owners_for(total // 8), max(1, total // bucket_bytes)

    def minis(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        data, bounds = bytes_of(batch.column("text"))
        begin, _, mini = pieces(data, bounds, window, bits)
        return by_value(mini, column(batch, "id")[np.searchsorted(bounds, begin, side="right") - 1])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, block, marks in zip(batch.column("run").to_pylist(), batch.column("held"), batch.column("marks").to_pylist(), strict=True):
                yield suspects(R.read_run(block.as_py()), marks, window, n_owners, bits, n_buckets, run)

    marks = R.enough(held, minis, n_owners, bits, 2, crowd)
    blocks = held.join(marks, "run").mapInArrow(find, BLOCKS)
    return blocks.groupBy("bucket", "single").applyInArrow(lambda rows: bucket_marks(rows, window), MARKS)


def cover(bounds: np.ndarray, at: np.ndarray, n: np.ndarray, window: int) -> np.ndarray:
    """Which bytes some marked window covers."""
    change = np.zeros(int(bounds[-1]) + 1, np.int32)
    np.add.at(change, at, 1)
    np.add.at(change, at + n + window - 1, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeated_bytes(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = 50, run_bytes: int = R.RUN_BYTES, bucket_bytes: int = BUCKET_BYTES, crowd: int = CROWD
) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans (maximal removed runs of bytes), kept (the bytes that stay).

    A byte goes if a string of `window` bytes (2 to 139) of its document covers it that also starts in a document with a smaller id; strings are
    judged on the input, overlaps count, none crosses a text's end. Texts are taken as UTF-8; null counts as empty, texts shorter than the
    window keep all. Rows with a null id keep theirs and take no part; rows that repeat an id count as one document, none removes the
    other's bytes. Other columns are not read. An empty table gives an empty result.
    """
    rows = docs.select(col(doc_id).cast("long").alias("id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    known = rows.filter("id IS NOT NULL")
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    held = R.write_runs(known, "text", run_bytes)
    # What the exchange shuffled is not needed after this.
    found = cut(repeated_runs(held, total, window, bucket_bytes, crowd)).groupBy("run").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *spans in zip(batch.column("held"), batch.column("at"), batch.column("n"), strict=True):
                run = R.read_run(block.as_py())
                data, bounds = bytes_of(run.column("text"))
                at, n = (x.values.flatten().to_numpy(zero_copy_only=False).astype(np.int64) if x.is_valid else np.zeros(0, np.int64) for x in spans)
                gone = cover(bounds, at, n, window)
                starts = gone.copy()
                starts[1:] &= ~gone[:-1]
                starts[bounds[:-1][bounds[:-1] < len(gone)]] |= gone[bounds[:-1][bounds[:-1] < len(gone)]]
                inside = lambda x: (lambda c: c[bounds[1:]] - c[bounds[:-1]])(np.concatenate([[0], np.cumsum(x)]))
                left = data[~gone].tobytes()
                ends = np.cumsum(np.diff(bounds) - inside(gone))
                kept = [left[b:e] for b, e in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [run.column("id"), pa.array(np.diff(bounds)), pa.array(inside(gone)), pa.array(inside(starts)), pa.array(kept, pa.binary())],
                    ["id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept binary"
    nameless = rows.filter("id IS NULL").select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept")
    )
    return held.join(found, "run", "left").mapInArrow(strip, schema).unionByName(nameless)
