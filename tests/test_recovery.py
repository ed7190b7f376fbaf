"""No rows lost: racing writers, loads that land during maintenance, interrupted runs, unusable rows, complete metrics."""

import pytest
from conftest import now, rows
from pyspark.sql import functions as F

from delaylake import storage
from delaylake.config import LakeConfig
from delaylake.contract import inputs
from delaylake.operators import monitor
from delaylake.operators.upsert import upsert
from delaylake.plans import daily, health, ingest, maintenance, medallion
from delaylake.streaming import flows

DOC = '{"id": "%s", "route_id": %s, "_ts": 100, "trip_id": "t", "trip_update_timestamp": %s, "first_stop_delay_sec": 10, "ingested_at": "2024-01-01T00:00:00Z"}'


def documents(spark, *docs):
    """(id, route or None, feed time) as stored documents."""
    rows = [(DOC % (i, f'"{r}"' if r else "null", t), 100 + k) for k, (i, r, t) in enumerate(docs)]
    return spark.createDataFrame(rows, "value string, _ts bigint")


def dim(spark, cfg, *names):
    return spark.createDataFrame([(n, n, None, "SUBWAY", None, None) for n in names], cfg.spec(medallion.DIM).schema)


def test_the_losing_writer_touches_nothing(spark, cfg, monkeypatch):
    storage.publish(dim(spark, cfg, "A"), cfg, medallion.DIM)
    real = storage._commit

    def race(*args):
        # Another writer that began from the same version commits first.
        monkeypatch.setattr(storage, "_commit", real)
        storage.publish(dim(spark, cfg, "first"), cfg, medallion.DIM)
        real(*args)

    monkeypatch.setattr(storage, "_commit", race)
    with pytest.raises(RuntimeError, match="another writer"):
        storage.publish(dim(spark, cfg, "second"), cfg, medallion.DIM)
    assert rows(storage.read_table(spark, cfg, medallion.DIM), "route_id") == [("first",)]
    assert len(storage._Dir(spark, cfg.path(medallion.DIM)).names()) == 3  # two versions and the pointers


@pytest.mark.parametrize("job", [maintenance.compact, maintenance.cluster])
def test_load_landing_during_maintenance_is_kept(spark, cfg, base, monkeypatch, job):
    raw = inputs.hub_raw(base).limit(10)
    storage.append(raw, cfg, medallion.HUB, "early")
    real = storage.publish

    def late(*args, **kwargs):
        storage.append(raw, cfg, medallion.HUB, "late")
        return real(*args, **kwargs)

    monkeypatch.setattr(storage, "publish", late)
    job(spark, cfg, medallion.HUB)
    assert storage.read_table(spark, cfg, medallion.HUB).count() == 20
    assert storage.read_table(spark, cfg, "ops.commit_log").first()["rows_written"] == 10


def test_unusable_rows_are_counted_on_both_paths(spark, cfg):
    docs = documents(spark, ("ok", "A", 1704067200), ("ms", "A", 1704067200000), ("free", None, 1704067200), ("none", "B", "null"))
    other = LakeConfig(root=cfg.root, catalog="incremental")
    for lake, incremental in ((cfg, False), (other, True)):
        ingest.load_documents(spark, lake, docs, now=now())
        medallion.stream_silver(spark, lake) if incremental else medallion.run_silver(spark, lake)
        log = storage.read_table(spark, lake, "ops.run_log")
        assert rows(log.filter("job LIKE 'silver_%'"), "job", "rows") == [("silver_out_of_range", 1), ("silver_without_route", 1)]
    full, step = (rows(storage.read_stored(spark, x, medallion.SILVER)) for x in (cfg, other))
    assert full == step and len(full) == 2


def test_gold_takes_up_what_an_interrupted_run_left(spark, cfg, monkeypatch):
    reference = spark.createDataFrame([("A", "A", "Line A", "1")], "route_id string, route_short_name string, route_long_name string, route_type string")

    def crash(*_a, **_k):
        raise RuntimeError("lost driver")

    first = documents(spark, ("a", "A", 1704067200), ("b", "A", 1704153600))
    with monkeypatch.context() as m:
        m.setattr(medallion, "run_dimension", crash)
        with pytest.raises(RuntimeError, match="lost driver"):
            daily.run_daily(spark, cfg, first, reference, "2024-01-31", now(), incremental=True)
    assert storage.read_table(spark, cfg, medallion.SILVER).count() == 2
    assert storage.read_table(spark, cfg, medallion.GOLD).count() == 0
    jobs = {r["job"]: r["status"] for r in health.job_health(spark, cfg, F.current_timestamp(), ["daily_run"]).collect()}
    assert jobs == {"daily_run": "FAILURES"}
    daily.run_daily(spark, cfg, first, reference, "2024-01-31", now(), incremental=True)
    assert storage.read_table(spark, cfg, medallion.GOLD).count() == 2
    assert storage.load_ids(spark, cfg, medallion.CHANGED) == []


def test_documents_without_mark_are_counted(spark, cfg):
    docs = documents(spark, ("a", "A", 1704067200))
    unmarked = docs.withColumn("_ts", F.lit(None).cast("bigint"))
    assert ingest.load_documents(spark, cfg, unmarked, now=now()).rows == 0
    assert ingest.load_documents(spark, cfg, docs.union(unmarked), now=now()).rows == 1
    log = storage.read_table(spark, cfg, "ops.run_log").filter("job = 'documents_without_mark'")
    assert rows(log, "rows") == [(1,), (1,)]


def test_a_poll_has_one_instant_and_is_sent_once(spark, cfg, base):
    entities, sent = inputs.entities(base).select("id", "trip_update"), []
    keep = lambda df: sent.extend(r[0] for r in df.select("value").collect())
    first = ingest.ingest_cycle(spark, cfg, entities, "b1", send=keep)
    assert len(sent) == first["stream"] > 0
    again = ingest.ingest_cycle(spark, cfg, entities, "b1", send=keep)
    assert again == {"batch": 0, "stream": 0} and len(sent) == first["stream"]
    stored = storage.read_table(spark, cfg, "docs.gtfs_rt_batch").union(storage.read_table(spark, cfg, "docs.gtfs_rt_stream"))
    times = stored.select(F.get_json_object("value", "$.metadata.ingested_at").alias("t")).distinct().collect()
    assert len(times) == 1 and times[0].t in sent[0]


def test_metrics_of_all_micro_batches(spark, cfg, base, tmp_path):
    raw = inputs.batch(base).repartition(9)
    raw.write.parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for k, part in enumerate(raw.randomSplit([1.0] * 7, 3)):
            storage.append(part.coalesce(1), cfg, medallion.EVENTS, f"l{k}")
        report = flows.run_flows(flows.bronze_flows(spark, cfg, max_files=1))
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "100")
    stored = storage.read_table(spark, cfg, medallion.EVENTS)
    assert report.metrics["flow.bronze_batch"]["rows"] == stored.count()
    assert report.metrics["flow.bronze_batch"]["valid_route_id"] == stored.filter("route_id IS NULL").count()
    flows.log_metrics(spark, cfg, report)
    log = storage.read_table(spark, cfg, "ops.run_log").filter("detail = 'flow.bronze_batch.rows'")
    assert rows(log, "rows") == [(stored.count(),)]


def test_generation_is_kept_in_the_lake(spark, cfg, base):
    assert storage.read_generation(spark, cfg) == 0
    assert storage.next_generation(spark, cfg) == 1 and storage.next_generation(spark, LakeConfig(root=cfg.root)) == 2
    assert storage.read_generation(spark, cfg) == 2
    later = cfg.at_generation(2)
    assert later.checkpoint("hub_to_bronze") == cfg.checkpoint("hub_to_bronze")
    assert later.checkpoint("x", refreshed=True) != cfg.checkpoint("x", refreshed=True)


def test_upsert_evaluates_each_side_once_and_spreads_null_keys(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n"), (2, "c")], "k int, v string")
    s = spark.createDataFrame([(1, "x"), (None, "m"), (3, "z")], "k int, v string")
    out = upsert(t, s, ["k"])
    assert rows(out) == rows(upsert(t, s, ["k"], null_keys=False)) == [(1, "x"), (1, "x"), (2, "c"), (3, "z"), (None, "m"), (None, "n")]
    many = spark.range(3000).select(F.when(F.col("id") < 0, F.lit(1)).alias("k"), F.col("id").cast("string").alias("v"))
    spread = upsert(many, s, ["k"])
    assert spread.count() == 3003
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range") == 1 and "hashpartitioning(k" in plan and "_spread" in plan


def test_overlong_runs(spark):
    log = spark.createDataFrame([("a", 1.8e6), ("b", 1.9e6), ("c", None)], "job string, latency_ms double")
    assert rows(monitor.overlong_runs(log), "job") == [("b",)]
