"""Micro-batches to bronze, append flows, the declarative pipeline."""

import pytest
from conftest import SF, now, rows
from pyspark.sql import functions as F

from delaylake import storage
from delaylake.contract import inputs
from delaylake.operators import facts, kpi, quality
from delaylake.operators.combine import union_all
from delaylake.plans import ingest, medallion
from delaylake.sources.messages import parse_hub, shape_messages
from delaylake.streaming import bronze, flows



@pytest.fixture
def messages(spark, base, tmp_path):
    """Four files of messages and a stream over them, one file per batch."""
    path = str(tmp_path / "topic")
    frame = inputs.hub_messages(base)
    frame.repartition(4).write.parquet(path)

    def stream():
        return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path)

    return frame, stream, path


def run_bronze(stream, cfg):
    query = bronze.start_bronze_stream(stream(), cfg, available_now=True)
    query.awaitTermination()
    return query


def test_stream_to_bronze_equals_batch_and_restarts(spark, cfg, messages):
    frame, stream, path = messages
    run_bronze(stream, cfg)
    cols = ("sequence_number", "offset", "enqueued_time", "payload")
    stored = storage.read_table(spark, cfg, medallion.HUB)
    assert rows(stored, *cols) == rows(shape_messages(frame), *cols)
    assert len(storage.load_ids(spark, cfg, medallion.HUB)) == 4
    log = storage.read_table(spark, cfg, "ops.run_log").filter("job = 'stream_batch_complete'")
    assert log.count() == 4 and log.agg(F.sum("rows")).first()[0] == frame.count()
    # A second run finds nothing; a new file becomes one more load.
    run_bronze(stream, cfg)
    assert len(storage.load_ids(spark, cfg, medallion.HUB)) == 4
    frame.limit(5).coalesce(1).write.mode("append").parquet(path)
    run_bronze(stream, cfg)
    assert storage.read_table(spark, cfg, medallion.HUB).count() == frame.count() + 5


def test_replayed_batch_adds_nothing(spark, cfg, base):
    raw = inputs.hub_raw(base)
    assert storage.append(raw, cfg, medallion.HUB, "hub_to_bronze-g0-b000000000")
    assert not storage.append(raw, cfg, medallion.HUB, "hub_to_bronze-g0-b000000000")
    assert storage.read_table(spark, cfg, medallion.HUB).count() == raw.count()
    assert storage.append(raw.limit(3), cfg, medallion.HUB, "hub_to_bronze-g0-b000000000", replace=True)
    assert storage.read_table(spark, cfg, medallion.HUB).count() == 3


def test_malformed_messages_do_not_stop_silver(spark):
    payloads = [
        ('{"id": "a", "route_id": "A", "payload": {"trip_id": "t", "trip_update_timestamp": "x1",'
         ' "first_stop_delay_sec": "12"}, "metadata": {"ingested_at": "yesterday"}}',),
        ("not json",), (None,),
        ('{"id": "b", "payload": {"first_stop_delay_sec": 9999999999}}',),
    ]
    parsed = parse_hub(spark.createDataFrame(payloads, "payload string"))
    got = {r["id"]: r for r in parsed.collect() if r["id"]}
    assert got["a"]["first_stop_delay_sec"] == 12
    assert got["a"]["trip_update_timestamp"] is None and got["a"]["ingested_at"] is None
    assert got["b"]["first_stop_delay_sec"] is None
    assert parsed.filter("id IS NULL").count() == 2


@pytest.fixture
def lake(spark, cfg, base):
    """Bronze in several loads and the stored dimension."""
    docs = inputs.stored_docs(base)
    middle = docs.agg(F.expr("(min(_ts) + max(_ts)) div 2")).first()[0]
    ingest.load_documents(spark, cfg, docs.filter(F.col("_ts") <= middle), now=now())
    storage.append(inputs.hub_raw(base), cfg, medallion.HUB, "hub-0")
    ingest.load_reference(spark, cfg, inputs.route_records(spark, SF).drop("supplier"), "2024-01-30", now())
    medallion.run_dimension(spark, cfg, F.lit("2024-01-31").cast("date"))
    return docs


def expected_flow_rows(spark, cfg):
    both = union_all([
        facts.silver_from_batch(storage.read_table(spark, cfg, medallion.EVENTS)),
        facts.silver_from_hub(parse_hub(storage.read_table(spark, cfg, medallion.HUB))),
    ])
    return both


def test_declarative_pipeline_streams_equal_batch(spark, cfg, lake):
    cfg0, report = flows.run_declarative(spark, cfg, max_files=1)
    both = expected_flow_rows(spark, cfg)
    kept = quality.expect_or_drop(both, quality.SILVER_FACT_RULES)
    assert rows(storage.read_table(spark, cfg0, flows.SILVER)) == rows(kept)
    gold = kpi.kpi_daily(kept, cast_p95=False)
    assert rows(storage.read_table(spark, cfg0, "flow.gold_kpi_daily")) == rows(gold)
    assert report.metrics["flow.bronze_batch"]["rows"] == storage.read_table(spark, cfg, medallion.EVENTS).count()
    dropped = sum(report.metrics[f]["reasonable_delay"] for f in ("batch_to_silver", "hub_to_silver"))
    counts = {r["rule"]: r["violations"] for r in quality.violation_counts(both, quality.SILVER_FACT_RULES).collect()}
    assert dropped == counts["reasonable_delay"] > 0
    assert report.metrics["flow.gold_kpi_daily"]["positive_trip_count"] == 0
    assert storage.read_table(spark, cfg0, "flow.gold_kpi_enriched").count() == gold.count()

    # More documents: the next refresh reads only them; a full one starts over.
    ingest.load_documents(spark, cfg, lake, now=now())
    _, second = flows.run_declarative(spark, cfg)
    everything = quality.expect_or_drop(expected_flow_rows(spark, cfg), quality.SILVER_FACT_RULES)
    assert rows(storage.read_table(spark, cfg, flows.SILVER)) == rows(everything)
    total = storage.read_table(spark, cfg, medallion.EVENTS).count()
    assert second.metrics["flow.bronze_batch"]["rows"] == total - report.metrics["flow.bronze_batch"]["rows"]
    cfg1, full = flows.run_declarative(spark, cfg, full=True)
    assert cfg1.generation == 1 and full.metrics["flow.bronze_batch"]["rows"] == total
    assert rows(storage.read_table(spark, cfg1, flows.SILVER)) == rows(everything)


def test_a_failing_flow_leaves_the_other_running(spark, cfg, lake):
    flows.run_flows(flows.bronze_flows(spark, cfg))
    good, other = flows.silver_flows(spark, cfg)

    def broken():
        bad = quality.expect_or_fail(
            facts.silver_from_hub(parse_hub(storage.stream_table(spark, cfg, "flow.bronze_hub"))),
            {"no_rows": "event_sk IS NULL"},
        )
        return flows.append_flow("broken", bad, cfg)

    report = flows.run_flows([good, flows.Flow("broken", broken)])
    assert list(report.failures) == ["broken"] and "no_rows" in report.failures["broken"]
    stored = storage.read_table(spark, cfg, flows.SILVER)
    assert rows(stored.select("source_system").distinct()) == [("cosmos_batch",)]
    # After the repair the other flow adds its rows to the same table.
    assert not flows.run_flows([other]).failures
    assert stored.sparkSession is not None
    again = storage.read_table(spark, cfg, flows.SILVER)
    assert rows(again.select("source_system").distinct()) == [("cosmos_batch",), ("event_hub",)]


def test_timed_trigger_is_passed(spark, cfg, messages):
    _, stream, _ = messages
    query = bronze.start_bronze_stream(stream(), cfg, trigger="1 second")
    try:
        query.processAllAvailable()
        assert storage.read_table(spark, cfg, medallion.HUB).count() > 0
    finally:
        query.stop()
