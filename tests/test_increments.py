"""Branches side by side, footer aggregates, partial KPIs, day bitmaps and messages sent again."""

import threading

import pytest
from conftest import now, rows
from pyspark.sql import functions as F

from delaylake import storage
from delaylake.contract import inputs
from delaylake.operators import bitmaps, facts, kpi, monitor, partials, quality
from delaylake.plans import daily, ingest, medallion
from delaylake.plans.branches import POOL, BranchFailure, run_branches
from delaylake.streaming import flows


def test_branches_meet_and_have_pools_of_their_own(spark, cfg):
    both, seen = threading.Barrier(2, timeout=60), {}

    def branch(name):
        def go():
            both.wait()  # returns only while the other branch runs
            seen[name] = spark.sparkContext.getLocalProperty(POOL), spark.sparkContext.getLocalProperty("kept")
            return spark.range(10).count()
        return go

    spark.sparkContext.setLocalProperty("kept", "yes")
    assert run_branches(spark, cfg, "j", {"a": branch("a"), "b": branch("b")}) == {"a": 10, "b": 10}
    assert seen == {"a": ("j-a", "yes"), "b": ("j-b", "yes")}
    spark.sparkContext.setLocalProperty("kept", None)
    assert spark.sparkContext.getLocalProperty(POOL) is None


def test_a_failing_branch_leaves_the_other_complete(spark, cfg, base, monkeypatch):
    docs, records = inputs.stored_docs(base), inputs.route_records(spark, "/root/testdata/sf0.001").drop("supplier")
    with monkeypatch.context() as m:
        m.setattr(medallion, "run_silver", lambda *_a, **_k: 1 / 0)
        with pytest.raises(BranchFailure, match="division") as failed:
            daily.run_daily(spark, cfg, docs, records, "2024-01-31", now())
    assert list(failed.value.failures) == ["facts"] and "dimension" in failed.value.done
    assert storage.read_table(spark, cfg, medallion.DIM).count() > 0
    assert storage.read_table(spark, cfg, medallion.GOLD).count() == 0
    log = storage.read_table(spark, cfg, "ops.run_log").filter("result = 'FAILED'")
    assert {r["job"] for r in log.collect()} == {"daily_run", "daily_run.facts"}
    daily.run_daily(spark, cfg, docs, records, "2024-01-31", now())
    assert storage.read_table(spark, cfg, medallion.GOLD).count() > 0


def test_extent_comes_from_footers(spark, cfg, base):
    names = (medallion.EVENTS, medallion.HUB, medallion.SILVER, medallion.GOLD)
    extents = lambda: [(n, storage.stored_extent(spark, cfg, n), cfg.spec(n).stale_hours) for n in names]
    assert {r["latest"] for r in monitor.freshness_of(extents(), now()).collect()} == {"EMPTY"}
    storage.append(inputs.hub_raw(base), cfg, medallion.HUB, "hub")
    records = inputs.route_records(spark, "/root/testdata/sf0.001").drop("supplier")
    daily.run_daily(spark, cfg, inputs.stored_docs(base), records, "2024-01-31", now())
    usual = [(n, storage.read_table(spark, cfg, n), cfg.spec(n).ts_col, cfg.spec(n).stale_hours) for n in names]
    assert rows(monitor.freshness_of(extents(), now())) == rows(monitor.freshness(usual, now()))
    for n in names:
        plan = storage.stored_extent(spark, cfg, n)._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*), MAX(" in plan, n
    # The setting for the source is put back.
    assert "BatchScan" not in storage.read_table(spark, cfg, medallion.HUB)._jdf.queryExecution().executedPlan().toString()


def test_partials_of_micro_batches_equal_a_rebuild(spark, cfg, base):
    silver = quality.expect_or_drop(facts.silver_from_batch(inputs.batch(base)), quality.SILVER_FACT_RULES)
    for k in range(3):
        storage.append(silver.filter(F.pmod(F.crc32(F.col("event_sk").cast("binary")), F.lit(3)) == k), cfg, flows.SILVER, f"l{k}")
        for _ in range(2):  # nothing new the second time
            flows.partials_flow(spark, cfg).awaitTermination()
    stored = storage.read_table(spark, cfg, flows.PARTIALS)
    cols = ["kpi_date", "route_id", "trip_update_cnt", "avg_delay_sec"]
    assert rows(partials.kpi_from_partials(stored), *cols) == rows(kpi.kpi_daily(silver, cast_p95=False), *cols)


def test_percentile_of_partials_is_near_in_rank(spark):
    fact = spark.range(60_000).select(
        F.timestamp_seconds(F.lit(1_704_067_200)).alias("event_ts"), F.lit("A").alias("route_id"), F.lit("t").alias("trip_id"),
        F.when(F.col("id") % 10 != 0, F.pmod(F.xxhash64("id"), F.lit(50_000))).cast("int").alias("delay_sec"), F.lit(True).alias("is_valid"),
    ).persist()
    parts = partials.kpi_partials(fact.filter("pmod(xxhash64(delay_sec, 1), 2) = 0")).unionByName(partials.kpi_partials(fact.filter("NOT pmod(xxhash64(delay_sec, 1), 2) = 0")))
    got = partials.kpi_from_partials(parts).first()
    below = fact.filter(F.col("delay_sec") <= got["p95_delay_sec"]).count() / fact.filter("delay_sec IS NOT NULL").count()
    assert got["trip_update_cnt"] == 60_000 and abs(below - 0.95) < 0.004
    none = partials.kpi_from_partials(partials.kpi_partials(fact.withColumn("delay_sec", F.lit(None).cast("int")))).first()
    assert (none["trip_update_cnt"], none["avg_delay_sec"], none["p95_delay_sec"]) == (60_000, None, None)
    fact.unpersist()


def test_bitmaps_add_up_to_exact_counts(spark):
    # More values than one bitmap has bits, NULL keys and NULL days among them.
    events = spark.range(120_000).select(
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("k"), F.pmod(F.xxhash64("id"), F.lit(50_000)).cast("string"))).alias("key"),
        F.when(F.col("id") % 13 != 0, F.date_add(F.lit("2024-01-25").cast("date"), (F.col("id") % 45).cast("int"))).alias("d"),
    )
    numbers = bitmaps.numbered(events, "key")
    assert numbers.count() == numbers.select("number").distinct().count()
    assert numbers.agg(F.max("number")).first()[0] < 2 * numbers.count()
    got = bitmaps.distinct_by_period(bitmaps.day_bitmaps(events, numbers, "key", F.col("d")))
    known = events.filter("d IS NOT NULL AND key IS NOT NULL")
    want = [
        known.groupBy(F.lit(p).alias("period"), (F.col("d") if p == "day" else F.trunc("d", p)).alias("start")).agg(F.countDistinct("key"))
        for p in ("day", "week", "month")
    ]
    everything = known.agg(F.lit("all"), F.min("d"), F.countDistinct("key"))
    assert rows(got) == rows(want[0].union(want[1]).union(want[2]).union(everything))
    assert bitmaps.distinct_by_period(bitmaps.day_bitmaps(events.limit(0), numbers, "key", F.col("d"))).count() == 0


def test_messages_that_could_not_be_sent_are_sent_by_the_repeat(spark, cfg, base):
    entities, sent = inputs.entities(base).select("id", "trip_update"), []

    def lose(_values):
        raise ConnectionError("away")

    keep = lambda df: sent.extend(r[0] for r in df.select("value").collect())
    with pytest.raises(ConnectionError):
        ingest.ingest_cycle(spark, cfg, entities, "b1", now(), send=lose)
    stored = storage.read_table(spark, cfg, "docs.gtfs_rt_stream")
    assert stored.count() > 0 and sent == []
    assert ingest.ingest_cycle(spark, cfg, entities, "b1", now(), send=keep) == {"batch": 0, "stream": 0}
    assert sorted(sent) == sorted(r[0] for r in stored.select("value").collect())
    ingest.ingest_cycle(spark, cfg, entities, "b1", now(), send=keep)
    assert len(sent) == stored.count()
    # A poll without streamed documents has nothing to hand over.
    ingest.ingest_cycle(spark, cfg, entities.filter("false"), "b2", now(), send=lose)
