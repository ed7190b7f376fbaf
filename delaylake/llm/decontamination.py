"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A text that holds an item with at most e edits shares at least L - q + 1 - q * e of the item's q-grams with it, on diagonals (place
in the text less place in the item) that lie at most e apart. Shared q-grams are counted in overlapping bands of diagonals, so that
every such range lies inside one band; bands with enough of them are aligned, within the band only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm.shared import col, free_name
from delaylake.llm.words import chunks, span_hash, sums

Q = 8
EDIT_RATE = 0.1
BLOCK_CHARS = 1 << 20
FILTER_BITS = 22
FAR = 1 << 28
MATCH = "id long, item long, start int, stop int, edits int"


def normal(text: str | None) -> str:
    """Case folded, white space runs as one space, trimmed."""
    return " ".join((text or "").replace("\0", " ").casefold().split())


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class Items:
    """A block of benchmark items: their code points, edit budgets, and every q-gram with its item and place."""

    ids: list[int]
    texts: list[str]
    codes: list[np.ndarray]
    budget: np.ndarray
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray
    q: int


def index_items(rows: list[tuple[int, str]], q: int, edit_rate: float) -> Items:
    rows = [(i, t) for i, t in ((i, normal(t)) for i, t in rows) if t]
    codes = [points(t) for _, t in rows]
    length = np.array([len(c) for c in codes], np.int64)
    # The budget never exceeds what the lemma can filter: at least one q-gram has to survive.
    budget = np.minimum((length * edit_rate).astype(np.int64), np.maximum(0, length - q) // q)
    grams, item, place = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, c in enumerate(codes):
        n = len(c) - q + 1
        if n > 0:
            grams.append(gram_hashes(c, q))
            item.append(np.full(n, k))
            place.append(np.arange(n))
    g = np.concatenate(grams)
    order = np.argsort(g, kind="stable")
    return Items([i for i, _ in rows], [t for _, t in rows], codes, budget, g[order], np.concatenate(item)[order], np.concatenate(place)[order], q)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    at = np.arange(n)
    return span_hash(sums(codes.astype(np.uint64) + np.uint64(1)), at, at + q)


def regions(codes: np.ndarray, items: Items, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Item and first diagonal of each band that holds enough shared q-grams."""
    h = gram_hashes(codes, items.q)
    at = np.flatnonzero(filled[h >> np.uint64(64 - FILTER_BITS)])
    h = h[at]
    low, high = np.searchsorted(items.grams, h, "left"), np.searchsorted(items.grams, h, "right")
    size = high - low
    at, low, size = at[size > 0], low[size > 0], size[size > 0]
    entry = np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)
    item = items.item[entry]
    longest = max(map(len, items.codes), default=0)
    diagonal = np.repeat(at, size) - items.place[entry] + longest
    step = items.budget[item] + 1
    band = diagonal // step + 1
    width = (len(codes) + longest) + 2
    # Band b covers the diagonals of steps b - 1 and b: each diagonal lies in two bands.
    key = np.concatenate([item * width + band, item * width + band - 1])
    key, count = np.unique(key, return_counts=True)
    item, band = key // width, key % width
    length = np.array([len(c) for c in items.codes], np.int64)
    need = length - items.q + 1 - items.q * items.budget
    enough = count >= need[item]
    item, band = item[enough], band[enough]
    return item, (band - 1) * (items.budget[item] + 1) - longest


def align(codes: np.ndarray, items: Items, item: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits, start and stop of each item inside its band, all bands at once; a text boundary (0) can't be passed.

    A cell holds edits * 2**16 + the diagonal it started on, so the start travels with the cost.
    """
    n = len(item)
    length = np.array([len(items.codes[k]) for k in item], np.int64)
    width = int(2 * (items.budget[item].max() + 1))
    inside = np.arange(width) < 2 * (items.budget[item] + 1)[:, None]
    longest = int(length.max())
    text = np.zeros((n, longest), np.uint32)
    for r, k in enumerate(item):
        text[r, : length[r]] = items.codes[k]
    padded = np.concatenate([np.zeros(longest + width, np.uint32), codes, np.zeros(2 * (longest + width), np.uint32)])
    corner = diagonal + longest + width
    cost = np.where(inside, np.arange(width), FAR).astype(np.int64)
    edits, start, stop = np.full(n, FAR), np.zeros(n, np.int64), np.zeros(n, np.int64)
    columns = np.arange(width)
    for i in range(longest):
        seen = padded[corner[:, None] + i + columns]
        wall = seen == 0
        through = cost + np.where(wall, FAR, (seen != text[:, i][:, None]) * np.int64(1 << 16))
        skipped = np.full_like(cost, FAR)
        skipped[:, :-1] = cost[:, 1:] + (1 << 16)
        best = np.minimum(np.minimum(through, skipped), FAR)
        # Characters of the text alone: along the row, each costs one edit, a boundary too many.
        toll = np.cumsum(np.where(wall, FAR, 1 << 16), axis=1)
        cost = np.where(inside, np.minimum(np.minimum.accumulate(best - toll, axis=1) + toll, FAR), FAR)
        done = np.flatnonzero(length == i + 1)
        if len(done):
            at = cost[done].argmin(axis=1)
            found = cost[done, at]
            edits[done], start[done], stop[done] = found >> 16, diagonal[done] + (found & 0xFFFF), diagonal[done] + at + i + 1
    return edits, start, stop


def search(texts: list[str], items: Items, filled: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, stop, edits) of each occurrence within the budget; places are in the normal form."""
    joined = "\0".join(texts)
    codes = points(joined)
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    out = []
    item, diagonal = regions(codes, items, filled)
    for a in range(0, len(item), 256):
        part = slice(a, a + 256)
        edits, start, stop = align(codes, items, item[part], diagonal[part])
        for k, e, s, t in zip(item[part], edits, start, stop, strict=True):
            if e <= items.budget[k]:
                out.append((int(np.searchsorted(bounds, s, "right")) - 1, int(k), int(s), int(t), int(e)))
    for k, t in enumerate(items.texts):
        at = joined.find(t) if len(t) < items.q else -1
        while at >= 0:
            out.append((int(np.searchsorted(bounds, at, "right")) - 1, k, at, at + len(t), 0))
            at = joined.find(t, at + 1)
    # Two bands report one occurrence: of overlapping ones, the one with fewest edits stays.
    best: list[tuple[int, int, int, int, int]] = []
    for m in sorted(out, key=lambda m: (m[0], m[1], m[2])):
        if best and best[-1][:2] == m[:2] and m[2] < best[-1][3]:
            best[-1] = min(best[-1], m, key=lambda x: (x[4], x[2]))
        else:
            best.append(m)
    return [(d, k, s - int(bounds[d]), t - int(bounds[d]), e) for d, k, s, t, e in best]


def origins(text: str) -> list[int]:
    """For each character of the normal form, its place in the text; and the end."""
    out, gap, pending = [], False, 0
    for i, c in enumerate(text):
        for x in c.casefold():
            if x.isspace() or x == "\0":
                gap, pending = bool(out), pending if gap else i
            else:
                if gap:
                    out.append(pending)
                gap = False
                out.append(i)
    return [*out, len(text)]


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
    q: int = Q, edit_rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id, item, start, stop, edits): benchmark items that occur in a text with at most edit_rate edits per character of the item.

    Both sides are case folded and white space runs become one space; start and stop are code points of the original text. Whole items are
    searched in whole texts; items under q characters must occur exactly, and for items of a few q-grams the budget is what
    the lemma can filter, (L - q) / q. Null and empty texts and items match nothing; rows without id are left out; repeated rows and
    items give repeated matches. Empty tables give an empty result. The benchmark is taken in blocks of about block_chars
    characters, each searched in all texts, so a task holds one block.
    """
    docs = docs.select(col(doc_id).cast("long").alias("id"), col(text).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    known = benchmark.select(col(item_id).cast("long").alias("item"), col(item_text).alias("words")).filter("item IS NOT NULL AND words IS NOT NULL")
    n_blocks = max(1, -(-(known.agg(F.sum(F.length("words"))).first()[0] or 0) // block_chars))
    known = known.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(n_blocks)))
    found = None
    for block in range(n_blocks):
        rows = [(r[0], r[1]) for r in known.filter(F.col("block") == block).select("item", "words").collect()]
        part = in_block(docs, index_items(rows, q, edit_rate))
        found = part if found is None else found.union(part)
    return found


def in_block(docs: DataFrame, items: Items) -> DataFrame:
    # At most block_chars entries and the longest item; plain values, so that executors read them without this package.
    shared = docs.sparkSession.sparkContext.broadcast(vars(items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(**shared.value)
        filled = np.zeros(1 << FILTER_BITS, bool)
        filled[items.grams >> np.uint64(64 - FILTER_BITS)] = True
        for batch in chunks(batches, "text", 2 << 20):
            texts = batch.column("text").to_pylist()
            ids = batch.column("id").to_pylist()
            rows = []
            for d, k, s, t, e in search([normal(x) for x in texts], items, filled):
                place = origins(texts[d])
                rows.append((ids[d], items.ids[k], place[s], place[t - 1] + 1, e))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
                ["id", "item", "start", "stop", "edits"],
            )

    return docs.mapInArrow(run, MATCH)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows whose text holds no benchmark item, with all their columns; rows without id stay."""
    held = free_name(docs, "found_id")
    found = contamination(docs, benchmark, text, doc_id, **options).select(F.col("id").alias(held)).distinct()
    return docs.join(found, col(doc_id).cast("long") == col(held), "left_anti")
