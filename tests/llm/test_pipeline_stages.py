"""The corpus pipeline: every stage on its own input, and the whole run."""

import collections

import pytest
from conftest import SF
from llm_frames import none, odd  # noqa: F401
from test_dedup import near_brute
from test_search_and_text import edits_inside

import corpus_pipeline
from delaylake.llm import decontamination, mixing


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output rows of each stage, written and read again as in a run."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return {name: (before.collect(), after.collect(), after.columns) for name, before, after in out}


def test_stages_and_columns(steps):
    assert list(steps) == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(steps[k][2] == plain for k in list(steps)[:-1]) and steps["sharding"][2] == [*plain, "shard", "slot"]


def test_near_stage_equals_brute_force(steps):
    before, after, _ = steps["near_dedup"]
    kept = {i for i, _, _, stays in near_brute([(r.doc_id, r.text) for r in before], 5) if stays}
    assert {r.doc_id for r in after} == kept and len(after) == len(kept)


def test_contaminated_documents_go(steps, spark):
    before, after, _ = steps["decontamination"]
    items = [decontamination.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in after}
    for r in before:
        text = decontamination.normal(r.text)
        if any(i in text for i in items):
            assert r.doc_id not in left
        elif r.doc_id not in left:
            assert any(edits_inside(i, text) <= len(i) // 10 for i in items)


def test_mix_stage_repeats_whole_rows(steps, spark):
    before, after, _ = steps["mixing"]
    count = collections.Counter(map(tuple, after))
    assert set(count) <= set(map(tuple, before)) and set(count.values()) <= {1, 2}
    words = lambda rows: sum(len(r.text.split()) for r in rows if r.text)
    assert abs(words(after) / words(before) - 1.5) < 0.2 and mixing.BLOCKS > 1


def test_shard_stage_keeps_all_rows(steps):
    before, after, _ = steps["sharding"]
    assert collections.Counter(map(tuple, before)) == collections.Counter(tuple(r)[:-2] for r in after)
    assert sorted((r.shard, r.slot) for r in after) == [(s, k) for s in range(8) for k in range(len(after) // 8 + (s < len(after) % 8))]


def test_run_agrees_with_the_stages(steps, spark):
    assert collections.Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == collections.Counter(map(tuple, steps["sharding"][1]))


def test_stages_bear_odd_and_empty_tables(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert set(docs.columns) <= set(out.columns) and out.count() <= 2 * docs.count(), name
