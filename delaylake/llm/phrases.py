"""Phrases that occur more often than their parts explain, from count streams in prefix and suffix order.

Runs of text send what they count of one to four words as hashes; owners answer which add up to enough, and only those are counted exactly,
by their words. That leaves streams of counts: sorted by phrase, a first part meets its phrases (prefix order); keyed by the rest, the rests
meet theirs (suffix order). Counts of left parts, right parts and extensions come from merge joins of the sorted streams in lockstep.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylake.llm import runs as R
from delaylake.llm.shared import col, cut
from delaylake.llm.words import bytes_of, mix, span_hash, sums

LONGEST = 4
LEAST = 30
SHARE = 80
TOP = 2000
FACTOR = 2_000_000
NO_LANG = "und"
COUNTS = "key string, f long"

IS_BREAK = np.zeros(256, bool)
IS_BREAK[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
IS_WORD = ~IS_BREAK
IS_WORD[[0x20, 0x09]] = False


class Grams:
    """The words of a run, numbered by language and bytes, and the phrases of 1 to LONGEST words inside pieces, numbered exactly."""

    def __init__(self, batch: pa.RecordBatch, longest: int):
        data, bounds = bytes_of(batch.column("text"))
        data = data + ((data - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)
        word = IS_WORD[data]
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        inner = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
        begins[inner] = word[inner]
        ends[inner - 1] = word[inner - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        text = np.searchsorted(bounds, start, side="right") - 1
        lang = langs.indices.to_numpy()[text].astype(np.int64)
        # Words side by side: their bytes are the keys.
        lengths = end - start
        self.at = np.concatenate([[0], np.cumsum(lengths)])
        self.bytes = data[word]
        packed = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(self.at), pa.py_buffer(self.bytes)])
        number = packed.dictionary_encode().indices.to_numpy().astype(np.int64)
        _, spot, unit = np.unique(number * len(self.langs) + lang, return_index=True, return_inverse=True)
        self.lang_of, self.n_words = lang, np.bincount(lang, minlength=len(self.langs))
        # Each different word is hashed once, so 64-bit sums are as long as the vocabulary of the run and not as its text.
        held, bounds = bytes_of(packed.take(pa.array(spot)).view(pa.large_string()))
        running = sums(held.astype(np.uint64) + np.uint64(1))
        names = np.array([int.from_bytes(n.encode()[:8], "little") ^ len(n) for n in self.langs], np.uint64)
        unit_hash = mix(span_hash(running, bounds[:-1], bounds[1:]) ^ mix(names[lang[spot]] + np.uint64(1))) if len(spot) else np.zeros(0, np.uint64)
        piece = np.searchsorted(np.flatnonzero(IS_BREAK[data]), start)
        linked = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        del data, word, begins, ends, number, text, piece, held, running

        # Of each size: an occurrence of every different phrase, its hash and its count.
        self.sizes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        spots, code, n_units = np.arange(len(start)), unit, max(1, len(spot))
        known = unit_hash
        self.sizes.append((spot, known, np.bincount(unit, minlength=len(spot)) if len(unit) else np.zeros(0, np.int64)))
        for n in range(2, longest + 1):
            last = spots + n - 1
            keep = np.flatnonzero(last < len(start))
            keep = keep[linked[last[keep] - 1]]
            spots, code = spots[keep], code[keep]
            _, first, after, count = np.unique(code * n_units + unit[spots + n - 1], return_index=True, return_inverse=True, return_counts=True)
            known = mix(known[code[first]] * np.uint64(0x9E3779B97F4A7C15) + unit_hash[unit[spots[first] + n - 1]] + np.uint64(n)) if len(first) else known[:0]
            self.sizes.append((spots[first], known, count))
            code = after

    def values(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes of all sizes below 2**bits, and their counts."""
        shift = np.uint64(64 - bits)
        v, w = np.concatenate([h for _, h, _ in self.sizes]) >> shift, np.concatenate([c for _, _, c in self.sizes])
        if not len(v):
            return v, w
        order = np.argsort(v)
        v, w = v[order], w[order]
        new = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        return v[new], np.add.reduceat(w, new)

    def counted(self, marks: list[dict], n_owners: int, bits: int) -> pa.RecordBatch:
        """Phrases behind set marks and their counts; and under an empty phrase all words of each language.

        A key is the language, a line break (which phrases never hold) and the phrase: one value a row is shuffled, not two.
        """
        values, _ = self.values(bits)
        enough = values[R.marked(values, marks, n_owners, bits)]
        names = [f"{n}\n" for n in self.langs]
        keys, counts = list(names), self.n_words.tolist()
        held, shift = self.bytes.tobytes(), np.uint64(64 - bits)
        for n, (spot, known, count) in enumerate(self.sizes, 1):
            place = np.searchsorted(enough, known >> shift)
            hit = np.flatnonzero(enough[np.minimum(place, len(enough) - 1)] == known >> shift) if len(enough) else []
            for s, c in zip(spot[hit].tolist(), count[hit].tolist(), strict=True):
                at = self.at[s : s + n + 1].tolist()
                keys.append(names[self.lang_of[s]] + b" ".join([held[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]).decode())
                counts.append(c)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(counts, pa.int64())], ["key", "f"])


def phrase_counts(docs: DataFrame, text: str, lang: str, least: int, longest: int, run_bytes: int) -> DataFrame:
    """(lang, phrase, f): exact counts of all phrases of 1 to `longest` words with f >= least, and of all words under an empty phrase."""
    rows = docs.select(F.coalesce(col(text).cast("string"), F.lit("")).alias("text"), F.coalesce(col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(8, min(60, total.bit_length() + 5))
    n_owners = R.owners_for(longest * total // 6)
    held = R.write_runs(rows, "text", run_bytes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, marks in zip(batch.column("held"), batch.column("marks").to_pylist(), strict=True):
                yield Grams(R.read_run(block.as_py()), longest).counted(marks, n_owners, bits)

    # Weights stop at 255, which is enough for any smaller bound; beyond it all that reaches 255 is counted.
    marks = R.enough(held, lambda batch: Grams(batch, longest).values(bits), n_owners, bits, min(least, 255))
    exact = held.join(marks, "run", "left").mapInArrow(count, COUNTS).groupBy("key").agg(F.sum("f").alias("f"))
    phrase = F.substring_index("key", "\n", -1)
    parts = exact.select(F.expr("left(key, length(key) - length(substring_index(key, '\\n', -1)) - 1)").alias("lang"), phrase.alias("phrase"), "f")
    return parts.filter((F.col("f") >= least) | (F.col("phrase") == ""))


def whole(x: Column) -> Column:
    """A count as a decimal, so that no product overflows."""
    return x.cast("decimal(19,0)")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, share: int = SHARE, top: int | None = TOP, longest: int = LONGEST, run_bytes: int = R.RUN_BYTES
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score), each language's `top` phrases (all if None) by score, a and phrase.

    A to Z are lowered, texts split at .,;:!? and 0x0A to 0x0D into pieces and those at spaces and tabs into words; phrases lie within
    pieces. n counts the language's words, a the phrase's occurrences (least at the fewest, overlaps included), l and r those of its parts at
    the cut with the lowest score floor(2000000 a / (l + r)), the first of such cuts. A phrase inside a longer one of `longest` words at most
    that has `share` per cent of its occurrences goes: some extension by one word then has as many, so those decide. Null texts count as
    empty, null languages as 'und', repeated rows count each; other columns are not read. A language without phrases has no row.
    """
    counts = cut(phrase_counts(docs, text, lang, least, longest, run_bytes))
    n = counts.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    known = counts.filter("phrase <> ''")
    parts = F.split("phrase", " ")
    longer = known.select("lang", "phrase", F.col("f").alias("a"), parts.alias("w")).filter(F.size("w") > 1)
    joined = lambda start, length: F.array_join(F.slice("w", start, length), " ")

    # Prefix order: a stream keyed by first parts meets the counts, both sorted by phrase.
    cuts = longer.select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.size("w") - F.col("k")).alias("right")
    )
    stream = lambda name, count: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(count)).hint("merge")
    cuts = cuts.join(stream("left", "l"), ["lang", "left"])
    # Suffix order: the same stream keyed by what is left over.
    cuts = cuts.join(stream("right", "r"), ["lang", "right"])
    score = F.expr(f"(cast({FACTOR} as decimal(9,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    scored = cuts.select("lang", "phrase", "a", "k", "l", "r", score.alias("score"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut")).select("lang", "phrase", "cut.*")

    # The largest count among phrases longer by one word on the left or the right.
    by_end = lambda part: longer.filter(F.size("w") > 2).select("lang", part.alias("phrase"), "a")
    extended = by_end(joined(F.lit(1), F.size("w") - 1)).unionByName(by_end(joined(F.lit(2), F.size("w") - 1)))
    extended = extended.groupBy("lang", "phrase").agg(F.max("a").alias("longer")).hint("merge")
    kept = best.join(extended, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * whole(F.col("longer")) < share * whole(F.col("a"))))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = kept.withColumn("rank", place.cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    # One row a language.
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
