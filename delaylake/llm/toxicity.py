"""Toxicity by a convolutional text classifier: hashed word embeddings, filters of several widths, max pooling, trained in numpy.

A word's vector is the sum of hashed vectors of the word and of its first bytes, so unseen endings share what their stem has
learned. Each filter looks at one, two or three neighbouring words; its largest answer over the whole text feeds a logistic unit.
Fitting takes every labelled row outside the held-out fold: partitions learn side by side and their weights are averaged after each round.
Scoring runs where the texts are. Thresholds are set by language on all those rows; the score itself never sees language, source or id.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm.shared import col, cut
from delaylake.llm.words import chunks, span_hash, words_of

SLOTS = 1 << 18
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
STEMS = (4, 5, 6)
# Bytes of text that one task learns from in a round, and of one block of it.
PART_BYTES = 32 << 20
BLOCK_BYTES = 2 << 20
RANGES = 256
PARTITIONS = "spark.sql.shuffle.partitions"
STEPS_A_UNIT = 1000
EPOCHS = 3
RATE = 0.1
BATCH = 64
STEP_WORDS = 200_000
THRESHOLD = 0.7
LEAST_POSITIVE = 20


@dataclass
class Model:
    """Weights of the network, the shift of its answer, and thresholds by language ('' for all others)."""

    vectors: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=lambda: {"": THRESHOLD})


def word_slots(texts: pa.Array, n_slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots (word and stems) of every different word, the number of each word among those, and the number of words of each text."""
    w = words_of(texts, lower=True, letters=True)
    _, first, back = np.unique(w.hashes, return_index=True, return_inverse=True)
    start, end = w.start[first], w.end[first]
    spans = [span_hash(w.running, start, np.minimum(end, start + n)) for n in (*STEMS, 1 << 40)]
    return (np.stack(spans, axis=1) % np.uint64(n_slots)).astype(np.int32), back, w.counts


def slots_of(texts: pa.Array, n_slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots (word and stems) of every word, and the number of words of each text."""
    table, back, counts = word_slots(texts, n_slots)
    return table[back], counts


def spread(x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word vectors with empty places after each text, one less than the widest filter, and where each text begins."""
    gap = max(WIDTHS) - 1
    first = np.concatenate([[0], np.cumsum(counts + gap)])[:-1]
    out = np.zeros((int((counts + gap).sum()) + gap, x.shape[1]), np.float32)
    out[np.arange(len(x)) + np.repeat(np.arange(len(counts)) * gap, counts)] = x
    return out, first


def answers(m: Model, x: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Of each width, every filter's answer at the first n places."""
    for k, w in enumerate(m.filters):
        z = x[:n] @ w[0]
        for j in range(1, len(w)):
            z += x[j : n + j] @ w[j]
        yield z + m.bias[k]


def logits(m: Model, slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
    x, first = spread(m.vectors[slots].sum(axis=1), counts)
    n = len(x) - max(WIDTHS) + 1
    pooled = [np.maximum(np.maximum.reduceat(z, first, axis=0), 0) * (counts > 0)[:, None] for z in answers(m, x, n)] if len(counts) else []
    return np.concatenate([*pooled, np.ones((len(counts), 1), np.float32)], axis=1) @ m.out if pooled else np.zeros(0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def blank(n_slots: int, rng: np.random.Generator) -> Model:
    vectors = rng.normal(0, 0.05, (n_slots, SIZE)).astype(np.float32)
    filters = [rng.normal(0, 0.4, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    out = np.append(rng.normal(0, 0.3, len(WIDTHS) * FILTERS), -2.0).astype(np.float32)
    return Model(vectors, filters, np.zeros((len(WIDTHS), FILTERS), np.float32), out)


def start_from_odds(m: Model, seen: np.ndarray, n: np.ndarray) -> None:
    """Begin with each slot's smoothed log odds between the classes in the first coordinate, which half of the filters read.

    From random vectors, max pooling seldom looks at the words of a small language; from here, it does at once. seen: of each class, how
    many texts hold each slot; n: how many texts it has.
    """
    rare = 3 / n.min()
    rates = seen / n[:, None] + rare
    m.vectors[:, 0] += (0.3 * np.log(rates[1] / rates[0])).astype(np.float32)
    for w in m.filters:
        w[:, 0, ::2] = np.abs(w[:, 0, ::2]) + np.float32(0.5 / len(w))
    m.out[:-1].reshape(len(WIDTHS), FILTERS)[:, ::2] = 0.3


def texts_with(slots: list[np.ndarray], labels: np.ndarray, n_slots: int) -> np.ndarray:
    """Of each class, how many texts hold each slot."""
    seen = np.zeros((2, n_slots), np.int64)
    for s, y in zip(slots, labels, strict=True):
        seen[int(y), np.unique(s)] += 1
    return seen


def steps(order: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """Rows in steps of BATCH rows and STEP_WORDS words at most; a longer text is a step of its own."""
    a, words = 0, 0
    for k, n in enumerate(counts.tolist()):
        if k > a and (k - a == BATCH or words + n > STEP_WORDS):
            yield order[a:k]
            a, words = k, 0
        words += n
    if len(order):
        yield order[a:]


@dataclass
class Squares:
    """Sums of squared gradients so far: one number a slot, and one a weight elsewhere."""

    vectors: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray


def no_squares(m: Model) -> Squares:
    return Squares(np.full(len(m.vectors), 1e-2, np.float32), [np.full_like(w, 1e-2) for w in m.filters], np.full_like(m.bias, 1e-2), np.full_like(m.out, 1e-2))


def one_pass(m: Model, seen: Squares, slots: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, rng: np.random.Generator, rate: float = RATE) -> None:
    """Adagrad on the weighted log loss, each text once; the gradient of max pooling reaches the winning places only."""

    def step(value, grad, square):
        square += grad * grad
        value -= rate * grad / np.sqrt(square)

    order = rng.permutation(len(slots))
    for rows in steps(order, np.array([len(slots[r]) for r in order])):
        counts = np.array([len(slots[r]) for r in rows])
        ids = np.concatenate([slots[r] for r in rows])
        # Some words are hidden in each pass, so no single rare word can carry a text.
        shown = (rng.random(len(ids)) > 0.1).astype(np.float32)
        x, first = spread(m.vectors[ids].sum(axis=1) * shown[:, None], counts)
        real, _ = spread(np.stack([np.arange(len(ids)) + 1, shown], axis=1), counts)
        at, top = [], []
        for z in answers(m, x, len(x) - max(WIDTHS) + 1):
            best = np.stack([z[f : f + max(1, c)].argmax(axis=0) + f for f, c in zip(first, counts, strict=True)])
            at.append(best)
            top.append(np.take_along_axis(z, best, axis=0))
        pooled = np.maximum(np.stack(top, axis=1), 0)
        flat = np.concatenate([pooled.reshape(len(rows), -1), np.ones((len(rows), 1), np.float32)], axis=1)
        error = ((sigmoid(flat @ m.out) - labels[rows]) * weights[rows] / len(rows)).astype(np.float32)
        back = error[:, None, None] * m.out[:-1].reshape(len(WIDTHS), FILTERS) * (pooled > 0)
        grad_x = np.zeros_like(x)
        for k, w in enumerate(m.filters):
            grad = np.zeros_like(w)
            for j in range(len(w)):
                places = at[k] + j
                grad[j] = np.einsum("rfd,rf->df", x[places], back[:, k])
                np.add.at(grad_x, places.ravel(), (back[:, k][:, :, None] * w[j].T[None]).reshape(-1, SIZE))
            step(w, grad, seen.filters[k])
        step(m.bias, back.sum(axis=0), seen.bias)
        step(m.out, flat.T @ error, seen.out)
        moved = np.flatnonzero((grad_x != 0).any(axis=1) & (real[:, 1] > 0))
        if len(moved):
            which, place = np.unique(ids[real[moved, 0].astype(np.int64) - 1].ravel(), return_inverse=True)
            grad = np.zeros((len(which), SIZE), np.float32)
            np.add.at(grad, place, np.repeat(grad_x[moved], len(STEMS) + 1, axis=0))
            seen.vectors[which] += (grad * grad).mean(axis=1)
            m.vectors[which] -= rate * grad / np.sqrt(seen.vectors[which])[:, None]


def fit_numpy(slots: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, n_slots: int = SLOTS, epochs: int = EPOCHS, rate: float = RATE, seed: int = 1) -> Model:
    """The network of rows that one process holds."""
    rng = np.random.default_rng(seed)
    m = blank(n_slots, rng)
    start_from_odds(m, texts_with(slots, labels, n_slots), np.array([(labels == 0).sum(), (labels == 1).sum()]))
    seen = no_squares(m)
    for _ in range(epochs):
        one_pass(m, seen, slots, labels, weights, rng, rate)
    return m


def best_cut(values: np.ndarray, hits: np.ndarray, n: np.ndarray) -> float:
    """The cut of best F1, where n rows have each value and hits of them the label 1; among equals, the middle of the widest gap."""
    order = np.argsort(-values)
    v, found = values[order], np.cumsum(hits[order])
    f1 = 2 * found / (np.cumsum(n[order]) + found[-1])
    lower = np.append(v[1:], v[-1] - 2.0)
    good = np.flatnonzero(f1 >= f1.max() - 1e-12)
    k = good[np.argmax((v - lower)[good])]
    return float((v[k] + lower[k]) / 2)


def labelled(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", label: str = "toxic", part_bytes: int = PART_BYTES
) -> DataFrame:
    """(id, text, size, lang, label): every row to learn from, size in bytes, dealt by id to partitions of about part_bytes of text.

    Those are all rows with a label 0 or 1 whose crc32(id as text) mod 3 is not 1. A row whose id has both labels comes with each. How many
    partitions there are and what each holds follows from the rows, not from files; a text is shuffled once.
    """
    marks = labels.select(col(doc_id).cast("long").alias("id"), col(label).cast("int").alias("label"))
    marks = marks.filter("label IN (0, 1)").filter(~held_out(F.col("id")))
    language = (col(lang) if lang in docs.columns else F.lit(None)).cast("string")
    size = F.coalesce(F.octet_length(col(text)), F.lit(0)).cast("long")
    rows = docs.select(col(doc_id).cast("long").alias("id"), col(text).alias("text"), size.alias("size"), language.alias("lang")).filter(~held_out(F.col("id")))
    # Sizes meet the labels without their texts.
    total = rows.select("id", "size").join(marks.distinct(), "id").agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    return rows.repartition(parts, "id").join(marks.repartition(parts, "id").distinct(), "id")


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


@dataclass
class Block:
    """Some rows to learn from: the slots of each different word, the words of all texts as numbers of those, and of each text its words' number."""

    table: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    labels: np.ndarray
    langs: list[str]

    def slots(self) -> list[np.ndarray]:
        return [self.table[w] for w in np.split(self.words, np.cumsum(self.counts)[:-1])]


def pack(rows: DataFrame, n_slots: int) -> DataFrame:
    """The rows of labelled() in compressed blocks, in the partitions they are in and in hash order there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in chunks(batches, "text", BLOCK_BYTES):
            table, words, counts = word_slots(batch.column("text"), n_slots)
            block = Block(table, words.astype(np.int32), counts, batch.column("label").to_numpy().astype(np.int8), [x or "" for x in batch.column("lang").to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array([squeeze(pickle.dumps(vars(block)))], pa.binary())], ["held"])

    turned = rows.withColumn("turn", F.xxhash64("id", "text")).sortWithinPartitions("turn", "id", "label", "lang")
    spark = rows.sparkSession
    before = spark.conf.get(PARTITIONS)
    # Spark deals both sides of a join again to as many partitions as the session asks for, unless that is fewer than they have.
    spark.conf.set(PARTITIONS, "1")
    try:
        return cut(turned.select("text", "lang", "label").mapInArrow(run, "held binary"))
    finally:
        spark.conf.set(PARTITIONS, before)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for held in batch.column("held"):
            yield Block(**pickle.loads(expand(held.as_py())))


def freeze(m: Model, seen: Squares) -> np.ndarray:
    """All numbers of the network and of its squares: a row a slot, and the others in rows of the same width behind them."""
    rest = np.concatenate([x.ravel() for x in (*m.filters, m.bias, m.out, *seen.filters, seen.bias, seen.out)])
    rest = np.append(rest, np.zeros(-len(rest) % (SIZE + 1), np.float32))
    return np.concatenate([np.column_stack([m.vectors, seen.vectors]), rest.reshape(-1, SIZE + 1)])


def thaw(held: np.ndarray, n_slots: int) -> tuple[Model, Squares]:
    rest, at, found = held[n_slots:].ravel(), 0, []
    shapes = [*[(w, SIZE, FILTERS) for w in WIDTHS], (len(WIDTHS), FILTERS), (len(WIDTHS) * FILTERS + 1,)]
    for shape in shapes * 2:
        found.append(rest[at : at + (size := int(np.prod(shape)))].reshape(shape).copy())
        at += size
    n = len(WIDTHS)
    return Model(held[:n_slots, :SIZE].copy(), found[:n], *found[n : n + 2]), Squares(held[:n_slots, SIZE].copy(), found[n + 2 : -2], *found[-2:])


def over_parts(held: DataFrame, work: Callable[[Iterator[Block], int], np.ndarray], mean: bool) -> np.ndarray:
    """What `work` gives for the blocks of each partition, added up, or averaged with its last column as the weight of each row.

    The arrays meet in RANGES ranges of their rows; the result has their size, whatever the number of partitions. Sums are in the order of
    partitions, so they are the same each time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = blocks_of(batches)
        first = next(blocks, None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        found = work(itertools.chain([first], blocks), part).astype(np.float32)
        held = [x.tobytes() for x in np.array_split(found, RANGES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(RANGES), pa.int32()), pa.array([part] * RANGES, pa.int32()), pa.array([found.shape[1]] * RANGES, pa.int32()), pa.array(held, pa.binary())], names)

    def add(parts: pa.Table) -> pa.Table:
        total = 0
        for width, x in zip(parts["width"].to_pylist(), parts.sort_by("part")["held"], strict=True):
            x = np.frombuffer(x.as_py(), np.float32).reshape(-1, width).astype(np.float64)
            if mean:
                x[:, :-1] *= x[:, -1:]
            total = total + x
        if mean:
            total = (total[:, :-1] / np.maximum(total[:, -1:], 1e-9)).astype(np.float32)
        return pa.table({"range": parts["range"][:1], "width": pa.array([total.shape[1]], pa.int32()), "held": pa.array([total.astype(np.float32 if mean else np.float64).tobytes()], pa.binary())})

    names = ["range", "part", "width", "held"]
    sent = held.mapInArrow(run, "range int, part int, width int, held binary")
    got = sorted(sent.groupBy("range").applyInArrow(add, "range int, width int, held binary").collect())
    return np.concatenate([np.frombuffer(r["held"], np.float32 if mean else np.float64).reshape(-1, r["width"]) for r in got])


def fit(rows: DataFrame, n_slots: int = SLOTS) -> Model:
    """Learn from all rows of labelled(): the odds to start from, the weights and the thresholds each take every row.

    Weights are learned in EPOCHS rounds. In each, every partition passes once over its rows, from the weights of the round before, and
    the weights of the partitions are averaged: a slot's by how often each partition has it, all others by rows. The driver and each task
    hold one network, whatever the number of rows. Without rows of both classes, the model answers 0 for every text.
    """
    n = dict(rows.groupBy("label").count().collect())
    if len(n) < 2:
        return silent()
    held = pack(rows, n_slots)
    spark = rows.sparkSession

    def count(blocks: Iterator[Block], part: int) -> np.ndarray:
        return sum(texts_with(b.slots(), b.labels, n_slots) for b in blocks).T

    m = blank(n_slots, np.random.default_rng(1))
    start_from_odds(m, over_parts(held, count, mean=False).T, np.array([n[0], n[1]]))
    weights = freeze(m, no_squares(m))
    for epoch in range(EPOCHS):
        shared = spark.sparkContext.broadcast(weights)

        def learn(blocks: Iterator[Block], part: int, shared=shared, epoch=epoch) -> np.ndarray:
            start = shared.value
            m, seen = thaw(start, n_slots)
            rng = np.random.default_rng([epoch, part])
            share, n_rows = np.zeros(n_slots), 0
            for b in blocks:
                one_pass(m, seen, b.slots(), b.labels.astype(np.float32), np.ones(len(b.labels), np.float32), rng)
                uses = np.bincount(b.words, minlength=len(b.table))
                share += np.bincount(b.table.ravel(), np.repeat(uses, b.table.shape[1]), n_slots)
                n_rows += len(b.labels)
            moved = freeze(m, seen) - start
            return np.column_stack([moved, np.append(share, np.full(len(start) - n_slots, n_rows))])

        weights = weights + over_parts(held, learn, mean=True)
        shared.destroy()
    return with_thresholds(held, thaw(weights, n_slots)[0])


def with_thresholds(held: DataFrame, m: Model) -> Model:
    """The best cuts of all rows and of each language with enough of them, on answers rounded to 1 / STEPS_A_UNIT."""
    shared = held.sparkSession.sparkContext.broadcast(vars(m))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        for b in blocks_of(batches):
            slots = b.slots()
            raw = np.concatenate([logits(m, np.concatenate(slots[a : a + BATCH]), b.counts[a : a + BATCH]) for a in range(0, len(b.counts), BATCH)])
            step = np.round(np.clip(raw, -60, 60) * STEPS_A_UNIT).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(b.langs, pa.string()), pa.array(step), pa.array(b.labels.astype(np.int32))], ["lang", "step", "label"])

    def cut_of(rows: pa.Table) -> pa.Table:
        value, hits, n = (rows[c].to_numpy() for c in ("step", "hits", "n"))
        return pa.table({"lang": rows["lang"][:1], "hits": pa.array([hits.sum()], pa.int64()), "n": pa.array([n.sum()], pa.int64()), "cut": pa.array([best_cut(value / STEPS_A_UNIT, hits, n)], pa.float64())})

    total = F.sum("hits").alias("hits"), F.sum("n").alias("n")
    by_lang = cut(held.mapInArrow(answer, "lang string, step int, label int").groupBy("lang", "step").agg(F.sum("label").alias("hits"), F.count("*").alias("n")))
    steps = by_lang.filter("lang <> ''").unionByName(by_lang.groupBy("step").agg(*total).withColumn("lang", F.lit("")))
    # A language has 120 * STEPS_A_UNIT steps at most.
    cuts = {r["lang"]: r for r in steps.groupBy("lang").applyInArrow(cut_of, "lang string, hits long, n long, cut double").collect()}
    shared.destroy()
    # The best cut for all gets the score THRESHOLD.
    m.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - cuts[""]["cut"])
    for lang, r in cuts.items():
        if lang and LEAST_POSITIVE <= r["hits"] < r["n"]:
            m.thresholds[lang] = float(sigmoid(np.array(r["cut"] + m.shift)))
    return m


def silent() -> Model:
    """Answers 0 for every text."""
    m = blank(1, np.random.default_rng(0))
    m.out[:] = np.append(np.zeros(len(m.out) - 1), -60.0)
    return m


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id", lang: str | None = "lang") -> DataFrame:
    """One row per input row: id, score (0 to 1), and rejected: whether it reaches the threshold of the row's language.

    Whole texts are scored; null, empty and wordless texts get the score of no evidence. Rows without id and repeated rows are rows like
    others; a missing or unknown language takes the common threshold. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    # Of fixed size: slots times SIZE numbers.
    shared = spark.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        for batch in chunks(batches, "text", 2 << 20):
            slots, counts = slots_of(batch.column("text"), len(m.vectors))
            found = sigmoid(logits(m, slots, counts).astype(np.float64) + m.shift)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("lang"), pa.array(found, pa.float64())], ["id", "lang", "score"])

    language = col(lang).cast("string") if lang and lang in docs.columns else F.lit(None).cast("string")
    rows = docs.select(col(doc_id).cast("long").alias("id"), language.alias("lang"), col(text).alias("text"))
    scored = rows.mapInArrow(run, "id long, lang string, score double")
    least = F.lit(model.thresholds[""])
    for name, value in model.thresholds.items():
        least = F.when(F.col("lang") == name, F.lit(value)).otherwise(least) if name else least
    return scored.select("id", "score", (F.col("score") >= least).alias("rejected"))


def reject(docs: DataFrame, model: Model, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """The rows whose score stays below the threshold of their language, with all their columns; nothing is shuffled.

    Null, empty and wordless texts have the score of no evidence; a missing or unknown language takes the common threshold; rows without
    id and repeated rows are rows like others. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    lang = lang if lang in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        for batch in chunks(batches, text, 2 << 20):
            slots, counts = slots_of(batch.column(text), len(m.vectors))
            found = sigmoid(logits(m, slots, counts).astype(np.float64) + m.shift)
            langs = batch.column(lang).to_pylist() if lang else [None] * batch.num_rows
            yield batch.filter(pa.array(found < np.array([m.thresholds.get(x or "", m.thresholds[""]) for x in langs], np.float64)))

    return docs.mapInArrow(run, docs.schema)
