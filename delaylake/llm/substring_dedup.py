"""Exact substring dedup by super-k-mer partitioning.

A window is `window` consecutive words. Its minimiser is the smallest hash among its runs of `seed` words; consecutive windows of a
document with the same bucket of the minimiser travel together as one packed string (a super-k-mer). Equal windows have equal minimisers,
so all their occurrences meet in one bucket. A task packs its text in runs: each run sends a bucket one compressed block with its
distinct super-k-mers and where they occur. A bucket numbers its words by value, sorts its windows, checks neighbours of equal hash
word by word and reports the windows whose words also start in an earlier document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm.shared import col
from delaylake.llm.words import Words, chunks, mix, span_hash, sums, words_of

SEED_WORDS = 3
BUCKET_BYTES = 12 << 20
RUN_BYTES = 4 << 20
PACKED = "bucket int, strings binary, code binary, doc binary, at binary"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[: len(values) - step], values[step:])
        done += step
    return values


def super_kmers(w: Words, window: int, seed: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and bucket of each maximal run of windows in one text that share a bucket."""
    n = len(w.start)
    if n < window:
        return (np.zeros(0, np.int64),) * 3
    starts = span_hash(sums(w.hashes), np.arange(n - seed + 1), np.arange(seed, n + 1))
    least = sliding_min(starts, window - seed + 1)
    # Mixed once more: the smallest of many hashes is a small number.
    bucket = (mix(least) % np.uint64(n_buckets)).astype(np.int64)
    text = w.text[: len(bucket)]
    whole = np.arange(len(bucket)) + window <= w.first[1:][text]
    at = np.flatnonzero(whole)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (np.diff(bucket[at]) != 0) | (np.diff(text[at]) != 0)
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at))), bucket[at[first]]


def pack(docs: DataFrame, window: int, seed: int, n_buckets: int) -> DataFrame:
    """(id, text) to blocks: distinct super-k-mers of a run of texts for a bucket, and their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in chunks(batches, "text", RUN_BYTES):
            w = words_of(batch.column("text"))
            begin, windows, bucket = super_kmers(w, window, seed, n_buckets)
            order = np.argsort(bucket, kind="stable")
            begin, windows, bucket = begin[order], windows[order], bucket[order]
            # One space after each word: the texts of equal words are equal byte for byte.
            lengths = w.end - w.start + 1
            ends = np.cumsum(lengths)
            joined = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
            inside = np.ones(len(joined), bool)
            inside[ends - 1] = False
            joined[inside] = w.data[((w.data - np.uint8(9)) > 4) & (w.data != 32)]
            held = joined.tobytes()
            low, high = (ends[begin] - lengths[begin]).tolist(), ends[begin + windows + window - 2].tolist()
            ids = batch.column("id").to_numpy(zero_copy_only=False)[w.text[begin]] if len(begin) else np.zeros(0, np.int64)
            at = begin - w.first[w.text[begin]] if len(begin) else begin
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(bucket) else []
            out: list[list] = [[], [], [], [], []]
            for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
                coded = pa.array([held[x:y] for x, y in zip(low[a:b], high[a:b], strict=True)], pa.binary()).dictionary_encode()
                out[0].append(int(bucket[a]))
                out[1].append(squeeze(b"\n".join(coded.dictionary.to_pylist())))
                out[2].append(squeeze(coded.indices.to_numpy().astype(np.int32).tobytes()))
                out[3].append(squeeze(ids[a:b].astype(np.int64).tobytes()))
                out[4].append(squeeze(at[a:b].astype(np.int32).tobytes()))
                if len(out[0]) == 512:
                    yield block(out)
                    out = [[], [], [], [], []]
            if out[0]:
                yield block(out)

    def block(out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], ["bucket", "strings", "code", "doc", "at"]
        )

    return docs.mapInArrow(run, PACKED)


def repeated_windows(packed: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one bucket that also start in an earlier document: document, first word, number of windows."""
    expand = zstandard.ZstdDecompressor().decompress
    strings, codes, docs, spots, known = [], [], [], [], 0
    for s, c, d, a in zip(*(packed.column(k) for k in ("strings", "code", "doc", "at")), strict=True):
        strings.append(expand(s.as_py()))
        codes.append(np.frombuffer(expand(c.as_py()), np.int32).astype(np.int64) + known)
        docs.append(np.frombuffer(expand(d.as_py()), np.int64))
        spots.append(np.frombuffer(expand(a.as_py()), np.int32))
        known += strings[-1].count(b"\n") + 1
    text = np.frombuffer(b"\n".join(strings), np.uint8)
    code, doc, spot = np.concatenate(codes), np.concatenate(docs), np.concatenate(spots)
    del strings, codes, docs, spots

    # Strings end with a space and are parted by a line feed; the words keep their space.
    feeds = np.flatnonzero(text == 10)
    text = np.delete(text, feeds)
    ends = np.flatnonzero(text == 32) + 1
    words = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(text)])
    word = words.dictionary_encode().indices.to_numpy().astype(np.uint64)
    del words
    last = np.append(np.searchsorted(ends, feeds - np.arange(len(feeds)), side="right"), len(ends))
    first = np.concatenate([[0], last[:-1]])
    count = last - first - window + 1
    offset = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(known), count)
    begin = np.arange(offset[-1]) - offset[owner] + first[owner]

    least = np.full(known, np.iinfo(np.int64).max)
    np.minimum.at(least, code, doc)
    hashes = span_hash(sums(mix(word + np.uint64(1))), begin, begin + window)
    order = np.argsort(hashes)
    group = np.zeros(len(order), np.int64)
    group[1:] = np.cumsum(hashes[order][1:] != hashes[order][:-1])
    del hashes
    again = np.flatnonzero(group[1:] == group[:-1]) + 1
    if len(again):
        x, y = begin[order[again]], begin[order[again - 1]]
        if any((word[x + k] != word[y + k]).any() for k in range(window)):
            # Different windows of one hash: number all windows by their words instead.
            table = np.stack([word[begin + k] for k in range(window)], axis=1)
            group = np.unique(table, axis=0, return_inverse=True)[1].ravel()
            order = np.argsort(group, kind="stable")
            group = group[order]
    new = np.flatnonzero(np.diff(group, prepend=-1))
    lowest = np.empty(len(order), np.int64)
    lowest[order] = np.repeat(np.minimum.reduceat(least[owner[order]], new), np.diff(np.append(new, len(order)))) if len(order) else 0

    # Occurrences with a window whose first document is an earlier one.
    floor = np.minimum.reduceat(lowest, offset[:-1]) if known else lowest
    hit = np.flatnonzero(floor[code] < doc)
    size = count[code[hit]]
    which = np.repeat(np.arange(len(hit)), size)
    step = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    marked = lowest[offset[code[hit]][which] + step] < doc[hit][which]
    d, p = doc[hit][which][marked], (spot[hit][which] + step)[marked]
    order = np.lexsort((p, d))
    d, p = d[order], p[order]
    new = np.ones(len(d), bool)
    new[1:] = (np.diff(d) != 0) | (np.diff(p) != 1)
    first = np.flatnonzero(new)
    return d[first], p[first].astype(np.int32), np.diff(np.append(first, len(d))).astype(np.int32)


def repeats(docs: DataFrame, text: str, doc_id: str, window: int, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(id, at, n): windows at words at to at + n - 1 of document id also start in a document with a smaller id."""
    docs = docs.select(col(doc_id).cast("long").alias("id"), col(text).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A word lies in about three super-k-mers.
    n_buckets = max(1, 3 * total // bucket_bytes)
    seed = min(SEED_WORDS, window)

    def find(packed: pa.Table) -> pa.Table:
        d, p, n = repeated_windows(packed, window)
        return pa.table({"id": d, "at": p, "n": n})

    return pack(docs, window, seed, n_buckets).groupBy("bucket").applyInArrow(find, "id long, at int, n int")


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = 13, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept (the words that stay, joined by one space).

    A word goes if a window of its document covers it whose words also start in a document with a smaller id; windows are judged on
    the input. Words are runs of anything but ASCII white space, compared unchanged. Null, empty and short texts have no window and keep their
    words; rows with a null id keep theirs and take no part; rows that repeat an id count as one document, none removes the
    other's words, and their windows are those of any of them at the same place. An empty table gives an empty result.
    """
    found = repeats(docs, text, doc_id, window, bucket_bytes).groupBy("id").agg(F.collect_list(F.struct("at", "n")).alias("runs"))
    rows = docs.select(col(doc_id).cast("long").alias("id"), col(text).alias("text")).join(found, "id", "left")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            w = words_of(batch.column("text"))
            runs = batch.column("runs")
            owner = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(runs).fill_null(0).to_numpy(zero_copy_only=False))
            at, n = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in runs.flatten().flatten())
            # Cover by +1 at the first word of a run of windows and -1 after its last.
            change = np.zeros(len(w.start) + 1, np.int64)
            if len(owner):
                begin = np.minimum(w.first[owner] + at, w.first[owner + 1])
                np.add.at(change, begin, 1)
                np.add.at(change, np.minimum(begin + n + window - 1, w.first[owner + 1]), -1)
            kept = np.cumsum(change[:-1]) == 0
            data, counts = w.data.tobytes(), w.counts
            left = np.add.reduceat(np.append(kept, False).astype(np.int64), w.first[:-1]) * (counts > 0) if batch.num_rows else counts
            out = []
            for a, b, k in zip(w.first[:-1], w.first[1:], left, strict=True):
                spots = np.arange(a, b) if k == b - a else a + np.flatnonzero(kept[a:b])
                out.append(b" ".join([data[x:y] for x, y in zip(w.start[spots].tolist(), w.end[spots].tolist(), strict=True)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts), pa.array(counts - left), pa.array(out, pa.binary()).cast(pa.string())], ["id", "n_words", "n_removed", "kept"]
            )

    return rows.mapInArrow(strip, "id long, n_words long, n_removed long, kept string")


