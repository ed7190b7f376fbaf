"""Near-duplicate documents: fast similarity sketches, banding, exact verification, connected components.

A document is the set of its distinct word shingles. Fast similarity sketching (Dahlgaard, Knudsen, Thorup 2017) fills
t coordinates: in each of the first t rounds every shingle falls into a hashed bin and the bin keeps its smallest value of the earliest round;
round t + j then sends every shingle to bin j, so each coordinate fills. Bands of coordinates are bucket keys.

Documents with equal sets form a class, its smallest id stands for it. In a bucket, members are compared with one pivot, not with each other;
further rounds take other pivots for what is not yet connected. Documents that share a bucket with many of a component
but have no link yet are then compared with that component block by block, each two blocks in a task of their own. What
else shares a bucket meets there by its rarest shingles: sets that are similar enough must share one of them (prefix filter, exact),
so documents of one template, which share only what is frequent, don't meet. Every link is confirmed on the full sets. Connected
documents need no further comparison, so large groups of copies cost rows in proportion to their size.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaylake.llm.components import connected_components
from delaylake.llm.shared import col, cut, free_name
from delaylake.llm.words import chunks, mix, ngrams, words_of

BANDS, ROWS = 32, 5
PIVOT_ROUNDS = 2
# Members of a component in one bucket from which on it is compared in blocks; this chooses the plan, not the result.
BLOCK_LEAST = 32
BLOCK_BYTES = 1 << 20
# Words from this length on, in bytes, get a cryptographic hash: of the polynomial one, long words can be made that collide.
LONG_WORD = 256
ITEMS = 1 << 17
SET_OF = ["row", "id", "size", "comp"]
SKETCH = "id long, n_shingles long, set_a long, set_b long, bands array<long>"


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts, and the text of each."""
    w = words_of(texts, lower=True)
    for k in np.flatnonzero(w.end - w.start >= LONG_WORD):
        w.hashes[k] = int.from_bytes(blake2b(w.data[w.start[k] : w.end[k]], digest_size=8).digest())
    return distinct(*ngrams(w, n))


def distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted by owner and then by hash; owners are below 65536."""
    order = np.argsort(hashes)
    order = order[np.argsort(owner[order].astype(np.uint16), kind="stable")]
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def sketch(items: np.ndarray, owner: np.ndarray, n_owners: int, t: int) -> np.ndarray:
    """t coordinates for each owner; owners without items keep the largest value in all of them."""
    empty = np.uint64(2**64 - 1)
    table = np.full(n_owners * t, empty, np.uint64)
    base = owner.astype(np.int64) * t
    for r in range(2 * t):
        if not len(items):
            break
        drawn = mix(items + np.uint64((r + 1) * 0xD6E8FEB86659FD93 % 2**64))
        if r < t:
            place = ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        else:
            place = np.int64(r - t)
        # The round stands above the hash, so an earlier round's value stays.
        np.minimum.at(table, base + place, (np.uint64(r) << np.uint64(54)) | (mix(drawn) >> np.uint64(10)))
        open_owners = (table.reshape(n_owners, t) == empty).any(axis=1)
        left = open_owners[owner]
        if not left.all():
            items, owner, base = items[left], owner[left], base[left]
    return table.reshape(n_owners, t)


def band_keys(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(table), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(table), np.uint64(b + 1))
        for k in range(b * rows, (b + 1) * rows):
            key = mix(key * np.uint64(0xA0761D6478BD642F) + table[:, k])
        keys[:, b] = key
    return keys


def sketches(docs: DataFrame, text: str, doc_id: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """Size, 128-bit fingerprint of the set and band keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            n = batch.num_rows
            items, owner = shingles(batch.column("text"), shingle)
            size = np.bincount(owner, minlength=n)
            first = np.concatenate([[0], np.cumsum(size)])[:-1]
            some = size > 0
            prints = np.zeros((2, n), np.uint64)
            if len(items):
                prints[0, some] = np.add.reduceat(mix(items ^ np.uint64(0x1234567)), first[some])
                prints[1, some] = np.bitwise_xor.reduceat(mix(items + np.uint64(0x89ABCDEF)), first[some])
            keys = band_keys(sketch(items, owner, n, bands * rows), bands, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(size.astype(np.int64)), pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys.view(np.int64).ravel())),
                ],
                ["id", "n_shingles", "set_a", "set_b", "bands"],
            )

    return docs.select(col(doc_id).cast("long").alias("id"), col(text).alias("text")).mapInArrow(run, SKETCH)


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, text) to (id, items): the sorted shingle hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            items, owner = shingles(batch.column("text"), shingle)
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            blobs = [items[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(blobs, pa.binary())], ["id", "items"])

    return docs.mapInArrow(run, "id long, items binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("items").alias("items_b")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("items").alias("items_a")), "a"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("items_a"), batch.column("items_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                shared = int((x[at] == y).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "items_a", "items_b").mapInArrow(run, "a long, b long").distinct()


def n_blocks(members: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """(comp, id) to the number of blocks of about BLOCK_BYTES that each component needs."""
    return members.join(sets.select("id", F.octet_length("items").alias("bytes")), "id").groupBy("comp").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).alias(name))


def in_blocks(members: DataFrame, sets: DataFrame, n: DataFrame, own: str, other: str, name: str) -> DataFrame:
    """(comp, id) to (comp, held, sought, name): the sets in blocks, each block once for every block of the other side."""
    # Only ids meet by component; sets are dealt out by component and both block numbers.
    m = members.join(n, "comp").select(
        "comp", "id", F.pmod(F.xxhash64("id"), own).alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other)
    )
    return m.join(sets, "id").groupBy("comp", "held", "sought").agg(F.collect_list(F.struct("id", "items")).alias(name))


def confirm_blocks(members: DataFrame, seekers: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the seekers and the members of each component."""
    n = n_blocks(members, sets, "held").join(n_blocks(seekers, sets, "sought"), "comp")
    key = ["comp", "held", "sought"]
    both = in_blocks(members, sets, n, "held", "sought", "held_sets").join(in_blocks(seekers, sets, n, "sought", "held", "sought_sets"), key)
    both = both.select("held_sets", "sought_sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for held, sought in zip(batch.column("held_sets").to_pylist(), batch.column("sought_sets").to_pylist(), strict=True):
                ids = np.array([r["id"] for r in held])
                sets = [np.frombuffer(r["items"], np.uint64) for r in held]
                size = np.array([len(x) for x in sets])
                items, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
                order = np.argsort(items)
                items, owner = items[order], owner[order]
                for r in sought:
                    x = np.frombuffer(r["items"], np.uint64)
                    low, high = np.searchsorted(items, x, "left"), np.searchsorted(items, x, "right")
                    at = np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low) + np.arange((high - low).sum())
                    shared = np.bincount(owner[at], minlength=len(ids))
                    for other in ids[100 * shared >= percent * (size + len(x) - shared)]:
                        if other != r["id"]:
                            a.append(min(int(other), r["id"]))
                            b.append(max(int(other), r["id"]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


def pivot_pairs(buckets: DataFrame, turn: int) -> DataFrame:
    """(bucket, id, size, comp) to pairs of each bucket's pivot with its members of other components and like size."""
    order = F.col("id") if turn == 0 else F.xxhash64(F.lit(turn), "bucket", "id")
    pivots = buckets.groupBy("bucket").agg(
        F.min_by(F.struct("id", "size", "comp"), F.struct(order, F.col("id"))).alias("p"), (F.min("comp") != F.max("comp")).alias("mixed")
    )
    pivots = pivots.filter("mixed").select("bucket", F.col("p.id").alias("a"), F.col("p.size").alias("size_a"), F.col("p.comp").alias("comp_a"))
    return buckets.join(pivots, "bucket").filter(F.col("comp") != F.col("comp_a"))


def like_size(x: str, y: str, percent: int):
    """Sets whose sizes differ more can't be that similar."""
    return (100 * F.least(x, y) >= percent * F.greatest(x, y))


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()


def exploded(sets: DataFrame) -> DataFrame:
    """(row, id, size, comp, items) to one row for each shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum([len(x.as_buffer()) // 8 for x in batch.column("items")])
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ITEMS, side="right")))
                some = batch.slice(at, to - at)
                held = [np.frombuffer(x.as_buffer(), np.int64) for x in some.column("items")]
                whose = pa.array(np.repeat(np.arange(len(held)), [len(x) for x in held]))
                yield pa.RecordBatch.from_arrays([*(some.column(c).take(whose) for c in SET_OF), pa.array(np.concatenate(held))], [*SET_OF, "item"])
                at = to

    return sets.select(*SET_OF, "items").mapInArrow(run, "row long, id long, size long, comp long, item long")


def rare_pairs(some: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, comp, buckets) to the pairs of different components that share a bucket and can have the similarity, by their rarest shingles.

    With all shingles in one order, sets whose intersection is at least m share one of the first size - m + 1 of each. The larger
    set needs m of at least percent of itself, the smaller one 2 percent / (100 + percent). Shingles of one component alone come
    first and are not joined, then rare ones.
    """
    # An id may have several sets.
    sets = sets.select("id", F.monotonically_increasing_id().alias("row"), F.expr("octet_length(items) DIV 8").alias("size"), "items")
    items = cut(exploded(sets.join(some.select("id", "comp"), "id")))
    known = items.groupBy("item").agg(F.count("*").alias("n"), (F.min("comp") != F.max("comp")).alias("mixed")).filter("mixed").select("item", "n")
    mine = W.partitionBy("row")
    place = F.col("size") - F.count("*").over(mine) + F.row_number().over(mine.orderBy("n", "item"))
    first = items.join(known, "item").select("id", "size", "comp", "item", place.alias("place"))
    first = cut(first.filter(F.col("place") <= F.col("size") - F.ceil(F.col("size") * percent / 100) + 1))
    first = first.join(some.select("id", "buckets"), "id").select("*", F.explode("buckets").alias("bucket"))
    small = first.filter(F.col("place") <= F.col("size") - F.expr(f"(2 * {percent} * size + {99 + percent}) DIV {100 + percent}") + 1)
    small = small.select("bucket", "item", *[F.col(c).alias(f"{c}_a") for c in ("size", "comp", "place", "buckets")], F.col("id").alias("a"))
    most = F.least("place", "place_a") + F.least(F.col("size") - F.col("place"), F.col("size_a") - F.col("place_a"))
    # A pair that shares several buckets meets in the smallest.
    return ordered(first.join(small, ["bucket", "item"]).filter(
        (F.col("comp") != F.col("comp_a")) & (F.col("size_a") <= F.col("size")) & like_size("size", "size_a", percent)
        & ((100 + percent) * most >= percent * (F.col("size") + F.col("size_a")))
        & (F.array_min(F.array_intersect("buckets", "buckets_a")) == F.col("bucket"))
    ))


def last_links(placed: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one bucket whose components no pivot has joined."""
    parts = placed.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    torn = parts.groupBy("bucket").agg(F.count("*").alias("comps"), F.max(F.struct("n", "comp")).alias("top")).filter("comps > 1")
    main = torn.select("bucket", F.when(F.col("top.n") >= BLOCK_LEAST, F.col("top.comp")).alias("main"))
    rest = cut(placed.join(main, "bucket").filter("main IS NULL OR comp <> main"))

    seekers = rest.filter("main IS NOT NULL").select(F.col("main").alias("comp"), "id").distinct()
    found = confirm_blocks(labels.join(seekers.select("comp").distinct(), "comp", "left_semi"), seekers, sets, percent)
    some = rest.groupBy("id", "comp").agg(F.collect_set("bucket").alias("buckets"))
    return found.union(confirm(rare_pairs(some, sets, percent), sets, percent))


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per input row with an id: id, n_shingles, component_id (smallest reachable id), kept (id = component_id).

    Texts are compared after lower-casing A to Z, by words; a text of fewer words than a shingle is one shingle; null, empty and
    blank texts have an empty set and are linked with nothing. Rows with a null id take no part and have no result row. Rows
    that repeat an id count as one document with all their texts. Rows of equal sets are linked whatever their number. An empty table
    gives an empty result. With 32 bands of 5, a pair of similarity 0.8 is missed with probability 3e-6, a closer one still less.
    """
    docs = docs.select(col(doc_id).cast("long").alias("id"), col(text).alias("text")).filter("id IS NOT NULL")
    rows_of = cut(sketches(docs, "text", "id", shingle, bands, rows))
    key = ["n_shingles", "set_a", "set_b"]
    classes = cut(rows_of.filter("n_shingles > 0").groupBy(*key).agg(F.min("id").alias("id"), F.min("bands").alias("bands")))
    rows_of = rows_of.select("id", *key)

    # With fewer than percent / (100 - percent) shingles, only equal sets are similar enough.
    least = percent // max(1, 100 - percent)
    keyed = classes.filter(F.col("n_shingles") >= least).select("id", F.col("n_shingles").alias("size"), F.explode("bands").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high").select("bucket")
    buckets = cut(keyed.join(shared, "bucket"))
    members = buckets.select("id").distinct()
    sets = cut(shingle_sets(docs.join(members, "id", "left_semi"), shingle))

    labels = members.withColumn("comp", F.col("id"))
    for turn in range(PIVOT_ROUNDS + 1):
        placed = buckets.join(labels, "id")
        if turn < PIVOT_ROUNDS:
            found = confirm(ordered(pivot_pairs(placed, turn).filter(like_size("size", "size_a", percent))), sets, percent)
        else:
            found = last_links(placed, labels, sets, percent)
        # Links between components so far, not between documents: few are left after the first round.
        for end in ("a", "b") if turn else ():
            found = found.join(labels.withColumnRenamed("id", end), end).drop(end).withColumnRenamed("comp", end)
        joined = connected_components(found).withColumnRenamed("comp", "joined")
        labels = labels.join(joined.withColumnRenamed("id", "comp"), "comp", "left").select("id", F.coalesce("joined", "comp").alias("comp"))
        labels = cut(labels)
    reps = classes.select(*key, F.col("id").alias("rep")).join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    found = rows_of.select("id", *key).join(reps, key, "left")
    component = F.coalesce("comp", "rep", "id")
    return found.select("id", "n_shingles", component.alias("component_id"), (F.col("id") == component).alias("kept"))


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows that stay, with all their columns: of each group of near duplicates those of the smallest id; rows without id stay."""
    held = free_name(docs, "gone_id")
    gone = near_duplicates(docs, text, doc_id, **options).filter("NOT kept").select(F.col("id").alias(held)).distinct()
    return docs.join(gone, col(doc_id).cast("long") == col(held), "left_anti")
