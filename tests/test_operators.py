"""Operators on small hand-written frames: the cases the given tables do not hold."""

import datetime as dt
import random

import pytest
from conftest import now, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from delaylake import fixed_values as fv
from delaylake import schemas
from delaylake.functions import (
    delay_label,
    doc_id,
    event_time,
    first_stop_delay,
    is_stream_route,
    kpi_date,
    kpi_date_by_text,
    path_key,
    route_type_label,
    stamp,
)
from delaylake.operators import combine, facts, kpi, monitor, quality, ranking, routes
from delaylake.operators.upsert import advance_watermark, append_if_absent, merge_sql, upsert
from delaylake.sources import documents, messages, reference

EVENT = (
    "id string, route_id string, trip_id string, trip_update_timestamp bigint, "
    "first_stop_delay_sec int, ingest_batch_id string, ingested_at timestamp"
)
T0 = dt.datetime(2024, 1, 1)


def events(spark, *data):
    """Rows of (id, route, trip, epoch, delay, ingested_at)."""
    return spark.createDataFrame([(i, r, t, e, d, "b", at) for i, r, t, e, d, at in data], EVENT)


# --- functions ---------------------------------------------------------------


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("mode, streams", [
    ("letter_to_stream", {"A", "a", " b ", "UNKNOWN", "", None, "É"}),
    ("numeric_to_batch", {"A", "a", " b ", "UNKNOWN", "", None, "É", "   ", "-1"}),
    ("numeric_to_stream", {"7", " 7X"}),
    ("explicit", {"7", "a", "A"}),
    ("no such mode", set()),
])
def test_segment_modes(spark, mode, streams):
    ids = ["A", "a", " b ", "7", " 7X", "UNKNOWN", "", None, "É", "   ", "-1"]
    df = spark.createDataFrame([(i,) for i in ids], "route_id string")
    got = df.filter(is_stream_route("route_id", mode, ["7", "A"])).collect()
    assert {r[0] for r in got} == streams


def test_explicit_mode_without_routes_sends_all_to_batch(spark):
    assert one(spark, is_stream_route(F.lit("A"), "explicit")) is False


def test_first_stop_delay_places(spark):
    stop = schemas.STOP_UPDATE
    data = [
        ("update", [(5, (6,), (7,))]), ("arrival", [(None, (6,), (7,))]),
        ("departure", [(None, (None,), (7,))]), ("no arrival", [(None, None, (8,))]),
        ("none", [(None, None, None)]), ("second only", [(None, None, None), (9, None, None)]),
        ("empty", []), ("null", None), ("zero", [(0, (6,), None)]),
    ]
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType

    df = spark.createDataFrame(data, StructType([StructField("k", StringType()), StructField("s", ArrayType(stop))]))
    got = {r["k"]: r["d"] for r in df.select("k", first_stop_delay("s").alias("d")).collect()}
    assert got == {"update": 5, "arrival": 6, "departure": 7, "no arrival": 8, "none": None,
                   "second only": None, "empty": None, "null": None, "zero": 0}


def test_trip_docs_defaults_and_ids(spark):
    import hashlib

    entity = schemas.FEED_ENTITY
    df = spark.createDataFrame([
        ("e1", (("A", "t1"), 100, [(5, None, None)])),
        ("e2", (("", None), 0, [])),
        ("e3", None),
    ], entity)
    docs = documents.trip_docs(df, "batch-1", now())
    got = {r["payload"]["feed_entity_id"]: r for r in docs.collect()}
    assert set(got) == {"e1", "e2"}
    blank = got["e2"]
    assert (blank["route_id"], blank["payload"]["trip_id"]) == ("UNKNOWN", "")
    assert blank["payload"]["trip_update_timestamp"] is None
    assert blank["id"] == hashlib.sha256(b"|0|e2").hexdigest()[:32]
    assert got["e1"]["id"] == hashlib.sha256(b"t1|100|e1").hexdigest()[:32]
    assert got["e1"]["metadata"]["ingested_at"] == "2024-01-31T00:00:00.000000+00:00"
    assert docs.schema["metadata"].dataType.names == schemas.METADATA.names
    batch, stream = documents.route_docs(docs)
    assert batch.count() == 0 and stream.count() == 2
    # What goes out as a message comes back as the same event.
    parsed = messages.parse_hub(documents.to_messages(docs).select(F.col("value").alias("payload")))
    assert rows(parsed, "id", "first_stop_delay_sec") == rows(
        docs.select("id", F.col("payload.first_stop_delay_sec").alias("first_stop_delay_sec")))


def test_keys_and_times(spark):
    assert one(spark, path_key(F.lit(None).cast("string"), "_eh_", F.lit(1))) is None
    without_time = one(spark, path_key(F.lit("a"), "_eh_", F.lit(None).cast("bigint")))
    assert without_time == one(spark, F.sha2(F.lit("a_eh_"), 256))
    assert one(spark, event_time(F.lit(None).cast("bigint"), F.lit(T0))) == T0
    assert one(spark, event_time(F.lit(0).cast("bigint"), F.lit(T0))) == dt.datetime(1970, 1, 1)
    late = F.lit("2024-01-01 23:59:59.9").cast("timestamp")
    assert one(spark, kpi_date(late)) == one(spark, kpi_date_by_text(late)) == dt.date(2024, 1, 1)
    assert one(spark, doc_id(F.lit(None).cast("string"), F.lit(None).cast("bigint"), F.lit("e"))) == one(
        spark, F.substring(F.sha2(F.lit("|0|e"), 256), 1, 32))
    assert one(spark, delay_label(F.lit(None).cast("double"))) == "N/A"
    assert one(spark, delay_label(F.lit(12.25))) == "12.3"
    assert [one(spark, route_type_label(F.lit(c))) for c in ("1", "2", "3", "4", None)] == [
        "SUBWAY", "RAILWAY", "BUS", "OTHER", "OTHER"]
    assert stamp(spark.range(1), "t").filter("t IS NOT NULL").count() == 1


def test_both_document_shapes_flatten(spark):
    texts = [
        '{"id": "n", "route_id": "A", "metadata": {"source_system": "s", "ingested_at": "2024-01-01T00:00:00Z"},'
        ' "payload": {"trip_id": "t", "trip_update_timestamp": 5, "first_stop_delay_sec": 6}}',
        '{"id": "f", "route_id": "B", "trip_id": "u", "trip_update_timestamp": 7, "ingested_at": "2024-01-01T00:00:00+01:00"}',
        '{"id": "bad", "ingested_at": "soon"}',
        'broken',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    flat = documents.flatten_docs(documents.parse_docs(df), now())
    assert flat.columns == schemas.BRONZE_EVENTS.names
    got = {r["id"]: r for r in flat.collect()}
    assert got["n"]["source"] == "s" and got["n"]["first_stop_delay_sec"] == 6
    assert got["f"]["source"] == fv.DEFAULT_SOURCE and got["f"]["trip_update_timestamp"] == 7
    assert got["f"]["ingested_at"] == dt.datetime(2023, 12, 31, 23)
    assert got["bad"]["ingested_at"] is None and None in got


def test_reference_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "routes.csv"
    path.write_bytes("﻿route_id,route_short_name,route_long_name,route_type,color\nA,A,\"8th, Ave\",1,\nSI,SIR,,2,blue\n".encode())
    csv = reference.read_routes_csv(spark, str(path))
    assert csv.columns[0] == "route_id"
    snap = reference.route_snapshot(csv, "2024-01-01", "ref-1", now())
    assert snap.columns == schemas.BRONZE_ROUTE_REF.names
    got = rows(routes.latest_routes(snap))
    assert got == [("A", "A", "8th, Ave", "SUBWAY"), ("SI", "SIR", None, "RAILWAY")]
    assert snap.filter("payload LIKE '%\"color\":\"blue\"%'").count() == 1


# --- dedup, upsert ----------------------------------------------------------------


def test_dedup_order(spark):
    batch = events(spark, ("a", "A", "t", 1, 10, T0), ("b", "A", "t", 1, 10, None), ("c", "A", "t", 1, 10, T0),
                   (None, "A", "t", 1, 10, T0), (None, "A", "t", 1, 12, T0))
    hub = events(spark, ("a", "A", "t", 1, 20, T0), ("b", "A", "t", 1, 20, T0),
                 ("c", "A", "t", 1, 20, T0 + dt.timedelta(seconds=1)))
    got = {r["id"]: r["first_stop_delay_sec"] for r in ranking.dedup_latest(combine.union_sources(batch, hub)).collect()}
    # Tie: batch. NULL time: last. Newer: wins. NULL ids: one row.
    assert got == {"a": 10, "b": 20, "c": 20, None: 12}


def test_dedup_does_not_depend_on_row_order(spark):
    rng = random.Random(7)
    data = [(f"k{rng.randrange(20)}", "A", "t", rng.randrange(3), rng.randrange(5),
             T0 + dt.timedelta(seconds=rng.randrange(2))) for _ in range(300)]
    first = None
    for _ in range(3):
        rng.shuffle(data)
        df = events(spark, *data).repartition(5)
        got = rows(facts.silver_fact(df, df.limit(0)))
        first = first or got
        assert got == first


def test_ranking_plan_limits_groups_before_the_shuffle(spark):
    df = events(spark, ("a", "A", "t", 1, 10, T0)).repartition(2)
    plan = ranking.dedup_latest(combine.union_sources(df, df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_stored_ranking_is_associative(spark):
    a = events(spark, ("x", "A", "t", 1, 1, T0), ("y", "A", "t", 1, 2, T0))
    b = events(spark, ("x", "A", "t", 1, 3, T0 - dt.timedelta(1)), ("y", "A", "t", 1, 4, T0 + dt.timedelta(1)))
    tagged = [facts.to_stored_silver(combine.tag_source(df, fv.TAG_BATCH)) for df in (a, b)]
    stepwise = ranking.dedup_stored(ranking.dedup_stored(tagged[0]).unionByName(tagged[1]))
    assert rows(stepwise) == rows(ranking.dedup_stored(tagged[1].unionByName(tagged[0])))
    assert rows(stepwise, "event_sk", "delay_sec") == [("x", 1), ("y", 4)]


KV = "k string, d date, v int, w int"


def test_upsert_all_columns_and_null_keys(spark):
    t = spark.createDataFrame([("a", None, 1, 1), ("b", None, 2, 2), (None, None, 3, 3)], KV)
    s = spark.createDataFrame([("b", None, 20, None), ("c", None, 30, 30), (None, None, 40, 40)], KV)
    once = upsert(t, s, ["k"])
    assert rows(once, "k", "v") == [("a", 1), ("b", 20), ("c", 30), (None, 3), (None, 40)]
    keyed = s.filter("k IS NOT NULL")
    assert rows(upsert(upsert(t, keyed, ["k"]), keyed, ["k"])) == rows(upsert(t, keyed, ["k"]))
    # A NULL key never matches, so repeating adds it again.
    assert upsert(once, s, ["k"]).count() == once.count() + 1


def test_upsert_listed_columns_two_keys(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    t = spark.createDataFrame([("a", d1, 1, 1), ("a", d2, 2, 2), ("b", None, 3, 3)], KV)
    s = spark.createDataFrame([("a", d1, 10, 10), ("c", d1, 30, 30), ("b", None, 40, 40)], KV)
    got = upsert(t, s, ["k", "d"], ["v"])
    assert got.columns == t.columns
    assert rows(got) == sorted([("a", d1, 10, 1), ("a", d2, 2, 2), ("b", None, 3, 3), ("b", None, 40, 40),
                                ("c", d1, 30, 30)], key=repr)
    # A matched row takes the source's NULL, too.
    nulls = spark.createDataFrame([("a", d1, None, None)], KV)
    assert upsert(t, nulls, ["k", "d"], ["v"]).filter("k = 'a' AND d = '2024-01-01'").first()["v"] is None


@pytest.mark.parametrize("cols", [None, ["v"]])
def test_upsert_can_reject_repeated_keys(spark, cols):
    t = spark.createDataFrame([("a", None, 1, 1)], KV)
    s = spark.createDataFrame([("a", None, 2, 2), ("a", None, 3, 3)], KV)
    with pytest.raises(Exception, match="several source rows for key, a"):
        upsert(t, s, ["k"], cols, unique=True).collect()


def test_merge_statement():
    assert merge_sql("c.s.t", "src", ["k", "d"], ["v"]) == (
        "MERGE INTO c.s.t AS t USING src AS s ON t.k = s.k AND t.d = s.d "
        "WHEN MATCHED THEN UPDATE SET t.v = s.v WHEN NOT MATCHED THEN INSERT *")


def test_watermark_and_snapshot_guard(spark):
    marks = spark.createDataFrame([("a", 1, T0)], schemas.WATERMARKS)
    got = advance_watermark(advance_watermark(marks, "a", 5, now()), "b", 7, now())
    assert rows(got, "source_key", "last_ts") == [("a", 5), ("b", 7)]
    snap = spark.createDataFrame([("A", dt.date(2024, 1, 1)), ("A", dt.date(2024, 1, 2))], "route_id string, snapshot_date date")
    assert append_if_absent(snap, snap.limit(1)).count() == 1
    assert append_if_absent(snap, snap.limit(0)).count() == 2


# --- routes -------------------------------------------------------------------------


REF = schemas.BRONZE_ROUTE_REF


def ref_rows(spark, *data):
    return spark.createDataFrame(
        [(r, d, '{"route_short_name": "%s", "route_type": "%s"}' % (s, t), "b", T0) for r, d, s, t in data], REF)


def test_three_tiers_and_both_plans_agree(spark):
    bronze = events(spark, ("1", "A", "t", 1, 1, T0), ("2", "7X", "t", 1, 1, T0), ("3", "new", "t", 1, 1, None),
                    ("4", None, "t", 1, 1, T0), ("5", "A", "t", 1, 1, T0 - dt.timedelta(3)))
    ref = ref_rows(spark, ("A", dt.date(2024, 1, 1), "old", "1"), ("A", dt.date(2024, 2, 1), "A-new", "3"),
                   ("unseen", dt.date(2024, 1, 1), "u", "9"))
    today = F.lit("2024-03-01").cast("date")
    fallback = routes.fallback_routes(spark)
    for reference_rows in (ref, ref.limit(0)):
        fast = routes.dim_route(bronze, reference_rows, fallback, today)
        plain = routes.with_first_seen(routes.resolve_routes(bronze, reference_rows, fallback), bronze, today)
        assert rows(fast) == rows(plain)
    got = {r["route_id"]: tuple(r)[1:5] for r in routes.dim_route(bronze, ref, fallback, today).collect()}
    assert got == {
        "A": ("A-new", None, "BUS", dt.date(2023, 12, 29)),
        "7X": ("7X", "Flushing Express", "SUBWAY", dt.date(2024, 1, 1)),
        "new": ("new", None, "UNKNOWN", dt.date(2024, 3, 1)),
        "unseen": ("u", None, "OTHER", dt.date(2024, 3, 1)),
    }


def test_latest_per_route_against_global_latest(spark):
    ref = ref_rows(spark, ("A", dt.date(2024, 1, 1), "a", "1"), ("B", dt.date(2024, 2, 1), "b", "1"))
    assert {r["route_id"] for r in routes.latest_routes(ref).collect()} == {"A", "B"}
    assert {r["route_id"] for r in ranking.global_latest(ref).collect()} == {"B"}
    assert ranking.global_latest(ref.limit(0)).count() == 0


def test_dimension_upsert_overwrites_without_history(spark):
    schema = schemas.SILVER_DIM_ROUTE
    old = spark.createDataFrame([("A", "x", "y", "BUS", dt.date(2020, 1, 1), dt.date(2021, 1, 1)),
                                 ("Z", "z", None, "BUS", dt.date(2020, 1, 1), None)], schema)
    staged = spark.createDataFrame([("A", "A", None, "SUBWAY", dt.date(2024, 1, 1), None)], schema)
    got = rows(routes.scd1_upsert(old, staged))
    assert got == [("A", "A", None, "SUBWAY", dt.date(2024, 1, 1), None), ("Z", "z", None, "BUS", dt.date(2020, 1, 1), None)]


# --- KPIs -----------------------------------------------------------------------------


def silver(spark, *data):
    return spark.createDataFrame([(f"k{i}", r, "t", ts, d, "b", v) for i, (r, ts, d, v) in enumerate(data)],
                                 "event_sk string, route_id string, trip_id string, event_ts timestamp,"
                                 " delay_sec int, ingest_batch_id string, is_valid boolean")


def test_kpi_of_a_group_without_delays(spark):
    fact = silver(spark, ("A", T0, None, True), ("A", T0, None, True), ("B", T0, 5, True), ("B", T0, 7, False))
    got = {r["route_id"]: tuple(r)[2:] for r in kpi.kpi_daily(fact).collect()}
    assert got == {"A": (2, None, None), "B": (1, 5.0, 5.0)}
    assert dict(kpi.kpi_daily(fact).dtypes)["p95_delay_sec"] == "double"
    assert dict(kpi.kpi_daily(fact, cast_p95=False).dtypes)["p95_delay_sec"] == "int"
    detail = {r["route_short_name"]: r["avg_delay"] for r in kpi.route_detail(
        kpi.kpi_daily(fact).select("*", F.col("route_id").alias("route_short_name"),
                                   F.lit("x").alias("route_long_name"), F.lit("y").alias("route_type"))).collect()}
    assert detail == {"A": "N/A", "B": "5.0"}


def test_p95_is_an_element(spark):
    fact = silver(spark, *[("A", T0, d, True) for d in range(100)])
    assert kpi.kpi_daily(fact).first()["p95_delay_sec"] == 94.0


def test_enriched_keeps_rows_of_ended_routes(spark):
    k = kpi.kpi_daily(silver(spark, ("A", T0, 1, True), ("B", T0, 1, True)))
    dim = spark.createDataFrame([("A", "a", None, "BUS", None, None), ("B", "b", None, "BUS", None, dt.date(2024, 1, 1))],
                                schemas.SILVER_DIM_ROUTE)
    got = {r["route_id"]: r["route_short_name"] for r in kpi.enrich(k, dim).collect()}
    assert got == {"A": "a", "B": None}
    flow = kpi.enrich_flow(k, kpi.flow_dim_route(dim))
    assert rows(flow) == rows(kpi.enrich(k, dim))


def test_daily_mean_is_over_routes(spark):
    fact = silver(spark, ("A", T0, 0, True), ("A", T0, 0, True), ("B", T0, 30, True))
    got = kpi.daily_summary(kpi.kpi_daily(fact)).first()
    assert (got["routes_active"], got["total_trip_updates"], got["overall_avg_delay_sec"]) == (2, 3, 15.0)


def test_report_order_and_limits(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(10)], "k int, v int")
    assert [r["v"] for r in ranking.sorted_desc(df, "v").collect()] == list(range(9, -1, -1))
    assert [tuple(r) for r in ranking.report(df, F.asc("k"), F.desc("v")).take(2)] == [(0, 9), (0, 6)]
    assert [r["v"] for r in ranking.newest(df, "v", 3).collect()] == [9, 8, 7]
    assert ranking.preview(df, 4).count() == 4
    assert rows(ranking.last_n_per(df, "k", "v", 2), "k", "v") == [(0, 6), (0, 9), (1, 4), (1, 7), (2, 5), (2, 8)]


# --- quality, monitoring ------------------------------------------------------------------


def test_warn_keeps_rows_and_counts(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", None)], "k string, v int")
    seen = Observation()
    rules = {"has_key": "k IS NOT NULL", "small": "v < 2"}
    assert quality.expect(df, rules, seen).count() == 3
    assert seen.get == {"rows": 3, "has_key": 1, "small": 2}  # NULL counts as violated
    assert rows(quality.violation_counts(df, rules)) == [("has_key", 1, 3), ("small", 2, 3)]


def test_drop_counts_before_dropping(spark):
    df = silver(spark, ("A", T0, 9000, True), ("A", T0, None, True), (None, T0, 1, True), ("A", None, 1, True),
                ("A", T0, 7200, True), ("A", T0, -3600, True), ("A", T0, -3601, True))
    seen = Observation()
    assert quality.expect_or_drop(df, quality.SILVER_FACT_RULES, seen).count() == 3
    assert seen.get == {"rows": 7, "valid_route_id": 1, "valid_trip_id": 0, "reasonable_delay": 2, "has_event_time": 1}


def test_fail_stops_even_when_columns_are_pruned(spark):
    dim = spark.createDataFrame([("A", None, None, "BUS", None, None)], schemas.SILVER_DIM_ROUTE)
    checked = quality.expect_or_fail(dim, quality.DIM_ROUTE_RULES)
    with pytest.raises(Exception, match="expectation has_route_name violated"):
        checked.select("route_type").collect()
    assert quality.expect_or_fail(dim.fillna("A", ["route_short_name"]), quality.DIM_ROUTE_RULES).count() == 1


def test_quality_of_an_empty_table(spark):
    empty = quality.quality_profile(silver(spark, ("A", T0, 1, True)).limit(0))
    assert empty.first()["valid_pct"] is None and empty.first()["total_events"] == 0
    assert quality.quality_status(empty).first()["status"] == "EMPTY"
    low = quality.quality_profile(silver(spark, *[("A", T0, 1, i > 0) for i in range(10)]))
    assert quality.quality_status(low).first()[:] == (90.0, "LOW")
    edge = quality.quality_profile(silver(spark, *[("A", T0, 1, i > 0) for i in range(20)]))
    assert quality.quality_status(edge).first()["status"] == "OK"


def test_validity_rules_differ(spark):
    rows_ = events(spark, ("a", "A", "t", 1, 1, None), ("b", "A", "t", None, 1, None), ("c", "A", "t", None, 1, T0))
    assert rows(facts.to_silver(rows_), "event_sk", "is_valid") == [("a", False), ("b", False), ("c", True)]
    flow = facts.silver_from_batch(rows_)
    assert [r["is_valid"] for r in flow.collect()] == [True, False, True]


def test_declarative_variant_keeps_both_paths(spark):
    one_event = events(spark, ("a", "A", "t", 1, 1, T0))
    both = facts.silver_from_batch(one_event).unionByName(facts.silver_from_hub(one_event))
    assert both.select("event_sk").distinct().count() == 2
    assert facts.silver_fact(one_event, one_event).count() == 1


def test_freshness_limits(spark):
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 30),)], "t timestamp")
    day = spark.createDataFrame([(dt.date(2024, 1, 29),)], "t date")
    got = {r["table_name"]: (r["age_hours"], r["status"]) for r in monitor.freshness(
        [("edge", ts, "t", 24), ("old", ts, "t", 23), ("day", day, "t", 48)], now()).collect()}
    # Exactly at the limit is not stale.
    assert got == {"edge": (24.0, "OK"), "old": (24.0, "STALE"), "day": (48.0, "OK")}


def test_run_health_and_recent_operations(spark):
    data = [("a", "1", dt.datetime(2024, 1, 30, 12), "TERMINATED", "SUCCESS"),
            ("b", "2", dt.datetime(2024, 1, 30, 13), "TERMINATED", "FAILED"),
            ("b", "3", dt.datetime(2024, 1, 30, 14), "RUNNING", None),
            ("c", "4", dt.datetime(2024, 1, 29), "TERMINATED", "FAILED")]
    log = spark.createDataFrame([(*d, None, None, None) for d in data], schemas.RUN_LOG)
    jobs = spark.createDataFrame([("a",), ("b",), ("c",)], "job string")
    got = {r["job"]: (r["runs"], r["failed"], r["running"], r["status"]) for r in monitor.run_health(log, jobs, now()).collect()}
    assert got == {"a": (1, 0, 0, "HEALTHY"), "b": (2, 1, 1, "FAILURES"), "c": (0, 0, 0, "NO RUNS")}
    commits = spark.createDataFrame([(None, i, T0, "WRITE", 1) for i in range(8)], schemas.COMMIT_LOG).drop("table_name")
    ops = monitor.recent_ops({"t": commits, "u": commits.limit(2)}, 5)
    assert {r["table_name"]: r["n"] for r in ops.groupBy("table_name").agg(F.count("*").alias("n")).collect()} == {"t": 5, "u": 2}


def test_export_goes_through_bounded_connections():
    from unittest.mock import MagicMock

    from delaylake.sources.jdbc import jdbc_overwrite

    df = MagicMock()
    writer = df.write.format.return_value.options.return_value
    writer.option.return_value = writer
    writer.mode.return_value = writer
    jdbc_overwrite(df, {"url": "jdbc:x"}, "dbo.t", connections=3, truncate=True)
    df.write.format.assert_called_once_with("jdbc")
    options = {c.args[0]: c.args[1] for c in writer.option.call_args_list}
    assert options == {"dbtable": "dbo.t", "numPartitions": 3, "truncate": "true"}
    writer.mode.assert_called_once_with("overwrite")
    writer.save.assert_called_once_with()
