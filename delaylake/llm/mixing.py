"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame functions only.

Every source has a weight and a size in words. Targets share the budget by weight; a target stops at `cap` times its
source's size and the excess is shared again, until none is above. A source's documents lie in permuted blocks; its target is an
exact quota of them: whole passes over all blocks, then further blocks in permuted order, the last one cut between two
documents. A tree then splits all drawn blocks among the output shards: at each node a random half of exact size goes
left, which is a multivariate hypergeometric draw over the sources. Inside a shard, rows are ordered by a keyed hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaylake.llm.shared import col, free_name, hashable

BLOCKS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words are runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(key, source, source_size) to the same with target: water level `level` times weight, at most cap times the size.

    In the order of cap per weight, a source is capped while the level that the rest would have is not below its own.
    """
    all_rows = W.partitionBy()
    place = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))).cast("int") + 1)
    s = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(cap))
    s = s.withColumn("per", F.col("most") / F.col("weight"))
    up = W.orderBy("per", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    budget = F.sum("source_size").over(all_rows) * F.lit(share)
    before = F.sum("most").over(up) - F.col("most")
    rest = F.sum("weight").over(all_rows) - F.sum("weight").over(up) + F.col("weight")
    s = s.withColumn("level", (budget - before) / rest).withColumn("capped", F.col("per") <= F.col("level"))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("per"), F.col("source").isNull(), F.col("source"), F.col("level")))).over(all_rows)
    s = s.withColumn("target", F.when(F.col("capped"), F.col("most")).otherwise(level["level"] * F.col("weight")))
    return s.select("key", "source", "source_size", "target")


def draw_blocks(stats: DataFrame, goals: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """(key, block, words) to (key, block, target, source_size, whole, part, rest, shards).

    whole: passes that take every document of the block; part: null, or the words of one further pass to take from it;
    shards: the output shard of each pass.
    """
    order = W.partitionBy("key").orderBy(F.xxhash64(F.lit(seed), "key", "block"), "block")
    b = stats.join(goals, "key").withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    b = b.withColumn("rest", F.round(F.col("target") - F.col("full") * F.col("source_size")).cast("long"))
    b = b.withColumn("before", F.sum("words").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("words"))
    inside = F.col("rest") - F.col("before")
    b = b.withColumn("whole", F.col("full") + (inside >= F.col("words")).cast("long") * (F.col("rest") > 0).cast("long"))
    b = b.withColumn("part", F.when((inside > 0) & (inside < F.col("words")), inside))
    passes = F.col("whole") + F.col("part").isNotNull().cast("long")
    units = b.filter(passes > 0).select("key", "block", F.explode(F.sequence(F.lit(0).cast("long"), passes - 1)).alias("pass"))
    leaves = split(units, n_shards, seed)
    lists = leaves.groupBy("key", "block").agg(F.transform(F.sort_array(F.collect_list(F.struct("pass", "shard"))), lambda x: x["shard"]).alias("shards"))
    return b.join(lists, ["key", "block"], "left").select("key", "block", "source_size", "target", "whole", "part", "shards")


def split(units: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """Deal units to shards down a binary tree; a node sends an exact random share of its units left."""
    u = units.withColumns({"lo": F.lit(0), "hi": F.lit(n_shards)})
    level = 0
    while (1 << level) < n_shards:
        node = W.partitionBy("lo", "hi")
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        rank = F.row_number().over(node.orderBy(F.xxhash64(F.lit(seed + 1 + level), "key", "block", "pass"), "key", "block", "pass"))
        left = F.floor(F.count(F.lit(1)).over(node) * (mid - F.col("lo")) / (F.col("hi") - F.col("lo")))
        goes = (F.col("hi") - F.col("lo") > 1) & (rank <= left)
        u = u.withColumns({"goes": goes, "mid": mid})
        u = u.withColumns({
            "lo": F.when(F.col("hi") - F.col("lo") <= 1, F.col("lo")).when(F.col("goes"), F.col("lo")).otherwise(F.col("mid")),
            "hi": F.when(F.col("hi") - F.col("lo") <= 1, F.col("hi")).when(F.col("goes"), F.col("mid")).otherwise(F.col("hi")),
        }).drop("goes", "mid")
        level += 1
    return u.select("key", "block", "pass", F.col("lo").alias("shard"))


def mix(
    docs: DataFrame, size: Column, source: str = "source", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
    cap: int = 2, n_shards: int = 8, seed: int = 1, blocks: int = BLOCKS,
) -> DataFrame:
    """All rows with size, source_size, target (its source's), copies (how often the mix takes the row) and shards (of each copy).

    Sources are taken in code point order, null last, and weigh `weights`, repeating. A row is taken at most cap times (cap is
    a whole number). Rows of size 0 follow their block and add no words. Repeated rows count as often as they occur. An empty table gives an empty result;
    input columns with the names of the new ones are replaced.
    """
    new = ("size", "source_size", "target", "copies", "shards")
    key, block, run, whole, part = (free_name(docs, f"mix_{n}") for n in ("key", "block", "run", "whole", "part"))
    sized = docs.withColumn("size", size.cast("long")).drop(*[c for c in docs.columns if c.lower() in new[1:]])
    named = hashable(sized)
    sized = sized.withColumns({
        key: F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string"))),
        block: F.pmod(F.xxhash64(F.lit(seed), *named), F.lit(blocks)).cast("int"),
    })
    stats = sized.groupBy(col(key).alias("key"), col(block).alias("block")).agg(F.sum("size").alias("words"), F.max(F.col(source)).alias("source"))
    sizes = stats.groupBy("key").agg(F.max("source").alias("source"), F.sum("words").alias("source_size"))
    drawn = draw_blocks(stats.select("key", "block", "words"), targets(sizes, weights, share, cap), n_shards, seed)
    drawn = drawn.withColumnsRenamed({"key": key, "block": block, "whole": whole, "part": part})
    inside = W.partitionBy(col(key), col(block)).orderBy(F.xxhash64(F.lit(seed + 1), *named), *named)
    ran = sized.withColumn(run, F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)))
    # A document is taken if its middle lies inside the quota, so the cut misses it by half a document at most.
    more = F.coalesce((2 * col(run) - F.col("size") <= 2 * col(part)).cast("long"), F.lit(0).cast("long"))
    out = ran.join(drawn, [key, block]).withColumn("copies", (col(whole) + more).cast("int"))
    out = out.withColumn("shards", F.slice(F.coalesce(F.col("shards"), F.array().cast("array<int>")), 1, F.col("copies")))
    return out.drop(key, block, run, whole, part)


def drawn_rows(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """One row per copy, with its output shard, and the local order inside the shard as a keyed hash."""
    shard = free_name(mixed, "mix_shard")
    return mixed.select(*columns, F.explode("shards").alias(shard))
