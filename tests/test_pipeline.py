"""Stored tables, re-runs, incremental against full, maintenance and health."""

import datetime as dt

import pytest
from conftest import SF, now, rows
from pyspark.sql import functions as F

from delaylake import storage
from delaylake.contract import inputs
from delaylake.operators import facts
from delaylake.operators.kpi import kpi_daily
from delaylake.plans import daily, export, health, ingest, maintenance, medallion
from delaylake.sources.messages import parse_hub

ROUTES_DAY = "2024-01-31"


@pytest.fixture
def docs(base):
    return inputs.stored_docs(base)


def hub_loads(base, cfg, n=2):
    raw = inputs.hub_raw(base)
    for i in range(n):
        part = raw.filter(F.col("sequence_number") % n == i)
        storage.append(part, cfg, "bronze.eventhub_gtfs_raw", f"hub-{i}")


def records(spark):
    return inputs.route_records(spark, SF).dropDuplicates(["route_id"]).drop("supplier")


def test_document_load_is_incremental_and_repeatable(spark, cfg, docs):
    middle = docs.agg(F.expr("(min(_ts) + max(_ts)) div 2")).first()[0]
    early = docs.filter(F.col("_ts") <= middle)
    first = ingest.load_documents(spark, cfg, early, now=now())
    assert first.rows == early.count() and first.mark_to == early.agg(F.max("_ts")).first()[0]
    second = ingest.load_documents(spark, cfg, docs, now=now())
    assert first.rows + second.rows == docs.count()
    third = ingest.load_documents(spark, cfg, docs, now=now())
    assert third.rows == 0 and third.mark_to == second.mark_to
    stored = storage.read_table(spark, cfg, "bronze.gtfs_rt_events")
    assert stored.count() == docs.count()
    assert stored.select("id").distinct().count() == docs.count()
    log = storage.read_table(spark, cfg, "ops.run_log")
    total = log.filter("job = 'batch_cycle_complete'").agg(F.sum("rows")).first()[0]
    by_route = log.filter("job = 'batch_route_ingest'").agg(F.sum("rows")).first()[0]
    assert total == by_route == docs.count()


def test_poll_cycles_feed_the_stores_and_the_daily_load(spark, cfg, base):
    from delaylake.operators.upsert import upsert
    from delaylake.sources.documents import trip_docs

    entities = inputs.entities(base).select("id", "trip_update")
    sent = []
    t1, t2 = (F.lit(f"2024-01-31 00:00:{s}").cast("timestamp") for s in ("00", "30"))
    first = ingest.ingest_cycle(spark, cfg, entities, "batch-1", t1, send=lambda df: sent.append(df.count()))
    assert sent == [first["stream"]] and min(first.values()) > 0
    assert sum(first.values()) == entities.filter("trip_update IS NOT NULL").count()
    ingest.ingest_cycle(spark, cfg, entities, "batch-1", t1)  # repeated: nothing added
    assert storage.read_table(spark, cfg, "docs.gtfs_rt_batch").count() == first["batch"]
    # The next poll brings some of the same documents again.
    part = entities.filter("id % 2 = 0")
    ingest.ingest_cycle(spark, cfg, part, "batch-2", t2)
    docs = ingest.stored_documents(spark, cfg)
    old, new = (trip_docs(e, b, t).filter("metadata.segment = 'batch'").select("id", "route_id", "metadata.ingest_batch_id")
                for e, b, t in ((entities, "batch-1", t1), (part, "batch-2", t2)))
    by_upsert = upsert(old, new, ["id", "route_id"])
    got = docs.select("id", "route_id", F.get_json_object("value", "$.metadata.ingest_batch_id").alias("b"))
    assert rows(got) == rows(by_upsert)
    assert ingest.load_documents(spark, cfg, docs, now=t2).rows == first["batch"]
    jobs = {r["job"]: r["runs"] for r in health.job_health(spark, cfg, now()).collect()}
    assert jobs["ingest_cycle"] == 2


def test_crash_between_load_and_mark_does_not_load_twice(spark, cfg, docs, monkeypatch):
    def crash(*_a, **_k):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(storage, "write_mark", crash)
        with pytest.raises(RuntimeError, match="lost driver"):
            ingest.load_documents(spark, cfg, docs, now=now())
    assert storage.read_mark(spark, cfg, "documents") == 0
    again = ingest.load_documents(spark, cfg, docs, now=now())
    assert again.rows == 0
    assert storage.read_table(spark, cfg, "bronze.gtfs_rt_events").count() == docs.count()
    assert storage.read_mark(spark, cfg, "documents") == docs.agg(F.max("_ts")).first()[0]


def test_same_second_documents_need_the_overlap(spark, cfg):
    def doc(i):
        text = '{"id": "%s", "route_id": "A", "_ts": 100, "ingested_at": "2024-01-01T00:00:00Z"}' % i
        return (text, 100)

    schema = "value string, _ts bigint"
    ingest.load_documents(spark, cfg, spark.createDataFrame([doc("a")], schema), now=now())
    late = spark.createDataFrame([doc("a"), doc("b"), (doc("c")[0].replace("100", "101"), 101)], schema)
    strict = ingest.load_documents(spark, cfg, late, now=now())
    assert strict.rows == 1  # b came late in the same second
    other = type(cfg)(root=cfg.root, catalog="overlap")
    ingest.load_documents(spark, other, spark.createDataFrame([doc("a")], schema), now=now())
    ingest.load_documents(spark, other, late, now=now(), overlap_sec=1)
    ids = rows(medallion.stage_silver(spark, other), "event_sk")
    assert ids == [("a",), ("b",), ("c",)]


def test_reference_snapshot_is_appended_once_per_day(spark, cfg):
    assert ingest.load_reference(spark, cfg, records(spark), "2024-01-01", now())
    n = storage.read_table(spark, cfg, "bronze.dim_route_ref").count()
    assert not ingest.load_reference(spark, cfg, records(spark), "2024-01-01", now())
    assert storage.read_table(spark, cfg, "bronze.dim_route_ref").count() == n
    assert ingest.load_reference(spark, cfg, records(spark), "2024-01-02", now())
    assert storage.read_table(spark, cfg, "bronze.dim_route_ref").count() == 2 * n


def test_daily_run_twice_gives_the_same_tables(spark, cfg, docs, base):
    hub_loads(base, cfg)
    daily.run_daily(spark, cfg, docs, records(spark), ROUTES_DAY, now())
    names = (medallion.SILVER, medallion.DIM, medallion.GOLD)
    before = {n: rows(storage.read_table(spark, cfg, n)) for n in names}
    again = daily.run_daily(spark, cfg, docs, records(spark), ROUTES_DAY, now())
    assert again.rows == 0
    assert before == {n: rows(storage.read_table(spark, cfg, n)) for n in names}
    # The stored result equals the plain composition of the operators.
    silver = facts.silver_fact(
        storage.read_table(spark, cfg, medallion.EVENTS), parse_hub(storage.read_table(spark, cfg, medallion.HUB))
    )
    assert rows(silver) == before[medallion.SILVER]
    assert rows(kpi_daily(silver)) == before[medallion.GOLD]
    enriched = medallion.enriched_kpi(spark, cfg)
    assert enriched.count() == len(before[medallion.GOLD])
    assert enriched.columns[2:5] == ["route_short_name", "route_long_name", "route_type"]
    frames = export.export_frames(spark, cfg)
    assert set(frames) == {"route_delay_kpi_daily", "dim_route", "route_delay_kpi_enriched"}
    assert frames["dim_route"].count() == len(before[medallion.DIM])


def test_incremental_run_equals_full_rebuild(spark, tmp_path, docs, base):
    from delaylake.config import LakeConfig

    inc = LakeConfig(root=str(tmp_path / "a"))
    full = LakeConfig(root=str(tmp_path / "b"))
    middle = docs.agg(F.expr("(min(_ts) + max(_ts)) div 2")).first()[0]
    raw = inputs.hub_raw(base)
    steps = [
        (docs.filter(F.col("_ts") <= middle), raw.filter(F.col("sequence_number") % 2 == 0)),
        (docs, raw.filter(F.col("sequence_number") % 2 == 1)),
    ]
    for i, (d, hub) in enumerate(steps):
        for cfg in (inc, full):
            storage.append(hub, cfg, medallion.HUB, f"hub-{i}")
            daily.run_daily(spark, cfg, d, records(spark), ROUTES_DAY, now(), incremental=cfg is inc)
    for name in (medallion.SILVER, medallion.DIM, medallion.GOLD):
        assert rows(storage.read_table(spark, inc, name)) == rows(storage.read_table(spark, full, name)), name


def test_incremental_merge_rewrites_only_changed_days(spark, cfg, docs):
    ingest.load_documents(spark, cfg, docs, now=now())
    medallion.stream_silver(spark, cfg)
    before = set(storage.state(spark, cfg, medallion.SILVER).dirs)
    late = '{"id": "late", "route_id": "A", "_ts": 9999999999, "trip_id": "t", "trip_update_timestamp": %d,' \
           ' "ingested_at": "2024-01-05T00:00:00Z"}' % 1704412800
    one = spark.createDataFrame([(late, 9999999999)], "value string, _ts bigint")
    ingest.load_documents(spark, cfg, one, now=now())
    assert medallion.stream_silver(spark, cfg) == [dt.date(2024, 1, 5)]
    after = set(storage.state(spark, cfg, medallion.SILVER).dirs)
    assert len(after - before) == 1 and len(before - after) == 1
    assert storage.read_table(spark, cfg, medallion.SILVER).filter("event_sk = 'late'").count() == 1
    # Nothing new: nothing changes.
    assert medallion.stream_silver(spark, cfg) == []


def test_older_late_copy_does_not_replace_newer(spark, cfg):
    def event(ingested, delay):
        return ('{"id": "x", "route_id": "A", "_ts": %d, "trip_id": "t", "first_stop_delay_sec": %d,'
                ' "trip_update_timestamp": 1704412800, "ingested_at": "%s"}' % (delay, delay, ingested), delay)

    schema = "value string, _ts bigint"
    ingest.load_documents(spark, cfg, spark.createDataFrame([event("2024-01-06T00:00:00Z", 1)], schema), now=now())
    medallion.stream_silver(spark, cfg)
    ingest.load_documents(spark, cfg, spark.createDataFrame([event("2024-01-05T00:00:00Z", 2)], schema), now=now())
    medallion.stream_silver(spark, cfg)
    assert rows(storage.read_table(spark, cfg, medallion.SILVER), "delay_sec") == [(1,)]


def test_event_that_moves_to_another_day_leaves_the_old_one(spark, cfg):
    def event(ingested, ts):
        # No feed time: the day comes from the ingestion time.
        return ('{"id": "x", "route_id": "A", "_ts": %d, "trip_id": "t", "ingested_at": "%s"}' % (ts, ingested), ts)

    schema = "value string, _ts bigint"
    for i, day in enumerate(("2024-01-05", "2024-01-07")):
        docs = spark.createDataFrame([event(f"{day}T00:00:00Z", i + 1)], schema)
        ingest.load_documents(spark, cfg, docs, now=now())
        medallion.stream_silver(spark, cfg)
    assert rows(storage.read_stored(spark, cfg, medallion.SILVER), "event_sk", "event_date") == [
        ("x", dt.date(2024, 1, 7))
    ]
    assert medallion.run_gold(spark, cfg) is not None
    assert rows(storage.read_table(spark, cfg, medallion.GOLD), "kpi_date") == [(dt.date(2024, 1, 7),)]


@pytest.mark.parametrize("incremental", [False, True])
def test_rows_without_id_are_counted_and_not_repeated(spark, cfg, base, incremental):
    raw = inputs.hub_raw(base)
    broken = raw.limit(3).withColumn("payload", F.lit("not json"))
    storage.append(raw.unionByName(broken), cfg, medallion.HUB, "hub-0")
    for _ in range(2):
        if incremental:
            medallion.stream_silver(spark, cfg)
        else:
            medallion.run_silver(spark, cfg)
        assert storage.read_table(spark, cfg, medallion.SILVER).count() == raw.count()
    log = storage.read_table(spark, cfg, "ops.run_log").filter("job = 'silver_without_id'")
    assert {r["rows"] for r in log.collect()} == {3}


def test_gold_keeps_rows_that_vanish_from_silver(spark, cfg, docs):
    ingest.load_documents(spark, cfg, docs, now=now())
    medallion.run_silver(spark, cfg)
    medallion.run_gold(spark, cfg)
    n = storage.read_table(spark, cfg, medallion.GOLD).count()
    stored = storage.read_stored(spark, cfg, medallion.SILVER)
    storage.publish(stored.filter("route_id <> 'A'"), cfg, medallion.SILVER)
    medallion.run_gold(spark, cfg)
    gold = storage.read_table(spark, cfg, medallion.GOLD)
    assert gold.count() == n and gold.filter("route_id = 'A'").count() > 0


def test_maintenance_keeps_rows_and_merges_files(spark, cfg, docs, base):
    hub_loads(base, cfg, n=5)
    ingest.load_documents(spark, cfg, docs, now=now())
    medallion.run_silver(spark, cfg)
    tables = (medallion.EVENTS, medallion.HUB, medallion.SILVER)
    before = {t: rows(storage.read_stored(spark, cfg, t)) for t in tables}
    files = {r["table"]: r["num_files"] for r in maintenance.table_detail(spark, cfg, tables).collect()}
    assert files[medallion.HUB] >= 5
    detail = maintenance.run_maintenance(spark, cfg, tables)
    after = {r["table"]: r for r in detail.collect()}
    assert after[medallion.HUB]["num_files"] == 1
    assert after[medallion.SILVER]["clustering_columns"] == ["route_id", "event_ts"]
    assert before == {t: rows(storage.read_stored(spark, cfg, t)) for t in tables}
    # A load that arrives after compaction is read next to the compacted copy.
    storage.append(inputs.hub_raw(base), cfg, medallion.HUB, "hub-late")
    assert storage.read_table(spark, cfg, medallion.HUB).count() == 2 * len(before[medallion.HUB])
    # Streams read the loads themselves, compacted or not.
    assert len(storage.load_ids(spark, cfg, medallion.HUB)) == 6


def test_clustered_files_have_disjoint_ranges(spark, cfg, docs):
    import glob

    import pyarrow.parquet as pq

    ingest.load_documents(spark, cfg, docs, now=now())
    maintenance.cluster(spark, cfg, medallion.EVENTS, ["route_id", "ingested_at"], target_mb=1)
    version = storage.state(spark, cfg, medallion.EVENTS).dirs[0]
    for path in glob.glob(f"{cfg.path(medallion.EVENTS)}/{version}/*.parquet"):
        routes = pq.read_table(path, columns=["route_id"]).column(0).to_pylist()
        assert routes == sorted(routes)


def test_statistics(spark, cfg, docs):
    ingest.load_documents(spark, cfg, docs, now=now())
    medallion.run_silver(spark, cfg)
    maintenance.compact(spark, cfg, medallion.SILVER)
    table = maintenance.analyze(spark, cfg, medallion.SILVER, ["route_id"])
    stats = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    n = storage.read_table(spark, cfg, medallion.SILVER).count()
    assert f"{n} rows" in stats["Statistics"]
    spark.sql(f"DROP TABLE {table}")


def test_old_versions_are_dropped_but_not_the_current(spark, cfg, docs):
    ingest.load_documents(spark, cfg, docs, now=now())
    for _ in range(3):
        medallion.run_silver(spark, cfg)
    expected = rows(storage.read_table(spark, cfg, medallion.SILVER))
    assert storage.drop_old_versions(spark, cfg, medallion.SILVER, keep=1)  and len(storage.state(spark, cfg, medallion.SILVER).dirs) > 0
    assert rows(storage.read_table(spark, cfg, medallion.SILVER)) == expected


def test_two_writers_cannot_commit_the_same_version(spark, cfg):
    dim = spark.createDataFrame([("A", "A", None, "SUBWAY", None, None)], storage.stored_contract(cfg.spec(medallion.DIM)))
    storage.publish(dim, cfg, medallion.DIM)
    with pytest.raises(RuntimeError, match="another writer"):
        storage._commit(spark, cfg, medallion.DIM, storage.State(1, ["v=1"]))


def test_not_null_contract(spark, cfg):
    schema = cfg.spec(medallion.DIM).schema
    text = "route_id string, route_short_name string, route_long_name string, route_type string," \
           " effective_from date, effective_to date"
    df = spark.createDataFrame([(None, "x", None, None, None, None), ("A", "A", None, None, None, None)], text)
    assert storage.conform(df, schema, "keep").count() == 2
    assert storage.conform(df, schema, "drop").count() == 1
    with pytest.raises(Exception, match="NULL in column route_id"):
        storage.conform(df, schema).collect()


def test_health_report(spark, cfg, docs, base):
    hub_loads(base, cfg)
    daily.run_daily(spark, cfg, docs, records(spark), ROUTES_DAY, now())
    report = health.report(spark, cfg, now()).first()
    assert report["tables"] == 5 and report["overall_status"] in ("HEALTHY", "NEEDS ATTENTION")
    assert report["total_events"] == storage.read_table(spark, cfg, medallion.SILVER).count()
    jobs = {r["job"]: r["status"] for r in health.job_health(spark, cfg, now()).collect()}
    assert jobs == {"batch_cycle_complete": "HEALTHY", "stream_batch_complete": "NO RUNS", "ingest_cycle": "NO RUNS"}
    ops = health.operations(spark, cfg).collect()
    assert {o["table_name"] for o in ops} >= {medallion.EVENTS, medallion.SILVER, medallion.GOLD}


def test_freshness_of_empty_tables(spark, cfg):
    got = {r["table_name"]: r for r in health.table_freshness(spark, cfg, now()).collect()}
    assert len(got) == 5
    assert all((r["row_count"], r["latest"], r["age_hours"], r["status"]) == (0, "EMPTY", 999.0, "STALE") for r in got.values())
    assert health.report(spark, cfg, now()).first()["reasons"] == "5 stale table(s), no silver events"


def test_views(spark, cfg, docs):
    ingest.load_documents(spark, cfg, docs, now=now())
    medallion.run_silver(spark, cfg)
    views = storage.register_views(spark, cfg, "t_")
    assert "t_gold_route_delay_kpi_enriched" in views
    n = spark.sql("SELECT count(*) FROM t_silver_fact_trip_delay_event").first()[0]
    assert n == storage.read_table(spark, cfg, medallion.SILVER).count()
