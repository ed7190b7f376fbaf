"""Sharding and mixing: exact sizes, quotas and their laws."""

import numpy as np
import pytest
from conftest import SF
from llm_frames import none, odd  # noqa: F401
from pyspark.sql import functions as F

from delaylake.llm import mixing, sharding
from delaylake.llm.queries import QUERIES


def test_hypergeometric_moments():
    rng = np.random.default_rng(3)
    drawn = [sharding.hypergeometric(rng, 300, 700, 200) for _ in range(4000)]
    assert abs(np.mean(drawn) - 60) < 0.5 and abs(np.var(drawn) - 200 * 0.3 * 0.7 * 800 / 999) < 2.5
    assert sharding.hypergeometric(rng, 5, 0, 3) == 3 and sharding.hypergeometric(rng, 0, 5, 3) == 0
    assert 0 <= sharding.hypergeometric(rng, 10**13, 10**13, 10**10) <= 10**10


def test_matrix_sums():
    blocks, cells = [7, 0, 13, 4], sharding.even(24, 5)
    m = sharding.communication_matrix(blocks, cells, 2)
    assert [sum(r) for r in m] == blocks and [sum(c) for c in zip(*m, strict=True)] == cells


def test_shards_are_even_and_gapless(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = sharding.shard(docs, 7).select("doc_id", "shard", "slot").collect()
    slots = {s: sorted(r.slot for r in out if r.shard == s) for s in range(7)}
    sizes = [len(v) for v in slots.values()]
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert max(sizes) - min(sizes) <= 1 and all(v == list(range(len(v))) for v in slots.values())
    # The order and partitions of the input play no part; another seed does.
    again = sharding.shard(docs.repartition(9).orderBy(F.rand()), 7).select("doc_id", "shard", "slot").collect()
    assert set(map(tuple, out)) == set(map(tuple, again))
    assert set(map(tuple, out)) != set(map(tuple, sharding.shard(docs, 7, seed=5).select("doc_id", "shard", "slot").collect()))


def test_shuffle_is_uniform(spark):
    rows = spark.range(4000).withColumnRenamed("id", "doc_id")
    out = sharding.shard(rows, 4).collect()
    # Neighbours of the input land in one shard about as often as chance has it, and slots don't follow ids.
    shard = {r.doc_id: r.shard for r in out}
    same = np.mean([shard[k] == shard[k + 1] for k in range(3999)])
    assert abs(same - 0.25) < 0.03
    assert abs(np.corrcoef([r.doc_id for r in out], [r.slot for r in out])[0, 1]) < 0.06


def test_odd_rows_are_sharded(odd, none):
    out = sharding.shard(odd, 3).collect()
    assert len(out) == odd.count() and sorted((r.shard, r.slot) for r in out) == [(s, k) for s in range(3) for k in range(4)]
    assert sharding.shard(none, 3).count() == 0


def water_level(sizes, weights, share, cap):
    """Targets by sharing the excess again and again."""
    budget, capped = share * sum(sizes), set()
    while True:
        rest = budget - sum(cap * sizes[k] for k in capped)
        total = sum(w for k, w in enumerate(weights) if k not in capped)
        goal = [cap * s if k in capped else rest * weights[k] / total for k, s in enumerate(sizes)]
        above = {k for k in range(len(sizes)) if k not in capped and goal[k] > cap * sizes[k]}
        if not above:
            return goal
        capped |= above


def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    out = mixing.mix(docs, mixing.word_count(F.col("text")), n_shards=5).collect()
    size, taken, goal = {}, {}, {}
    for r in out:
        size[r.source] = size.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r["size"] * r.copies
        goal[r.source] = r.target
        assert 0 <= r.copies <= 2 and len(r.shards) == r.copies and all(0 <= s < 5 for s in r.shards)
    names = sorted(size, key=lambda s: (s is None, s))
    want = water_level([size[s] for s in names], [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5, 2)
    longest = max(r["size"] for r in out)
    for s, w in zip(names, want, strict=True):
        assert goal[s] == pytest.approx(w, rel=1e-9) and abs(taken[s] - w) <= longest / 2 + 1
    assert sorted(map(repr, out)) == sorted(map(repr, mixing.mix(docs.repartition(5), mixing.word_count(F.col("text")), n_shards=5).collect()))


def test_tree_deals_evenly(spark):
    units = spark.range(1000).select(F.lit("s").alias("key"), F.col("id").cast("int").alias("block"), F.lit(0).alias("pass"))
    sizes = [r["count"] for r in mixing.split(units, 8, 1).groupBy("shard").count().collect()]
    assert sorted(sizes) == [125] * 8


def test_odd_rows_are_mixed(odd, none):
    out = mixing.mix(odd, mixing.word_count(F.col("text"))).collect()
    assert len(out) == odd.count() and {r.copies for r in out} <= {0, 1, 2}
    by = {(r.doc_id, r.source): r for r in out}
    assert by[(2, "a")]["size"] == 0 and by[(3, None)].source_size == 30_006
    assert mixing.mix(none, mixing.word_count(F.col("text"))).count() == 0
    rows = mixing.drawn_rows(mixing.mix(odd, mixing.word_count(F.col("text"))), ["doc_id", "text"])
    assert rows.count() == sum(r.copies for r in out)


def test_queries(spark):
    s = QUERIES["op2_hypergeometric_shards"](spark, SF)
    assert dict(s.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    m = QUERIES["op6_mixture"](spark, SF)
    assert dict(m.dtypes).items() >= {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}.items()
    assert s.count() == m.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
