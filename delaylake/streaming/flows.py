"""The declarative variant: streamed bronze and silver with expectations, recomputed gold."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from delaylake import storage
from delaylake.config import LakeConfig
from delaylake.functions import stamp
from delaylake.operators import kpi, partials, quality
from delaylake.operators.combine import union_all
from delaylake.operators.facts import silver_from_batch, silver_from_hub
from delaylake.sources.messages import parse_hub
from delaylake.streaming.bronze import start

SILVER = "flow.silver_fact"


@dataclass(frozen=True)
class Flow:
    """A named stream and how to start it."""

    name: str
    start: Callable[[], StreamingQuery]


@dataclass
class FlowReport:
    """Expectation metrics by dataset, and the flows that failed with their errors."""

    metrics: dict[str, dict[str, int]] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)

    def add(self, dataset: str, values: Mapping[str, int]) -> None:
        known = self.metrics.setdefault(dataset, {})
        for k, v in values.items():
            known[k] = known.get(k, 0) + (v or 0)


def single_writer_stream(
    df: DataFrame, cfg: LakeConfig, name: str, available_now: bool = True, trigger: str = "30 seconds"
) -> StreamingQuery:
    """Write a stream with the file sink, whose log hides uncommitted files from the next reader."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", cfg.path(name))
    return start(writer, cfg.checkpoint(name, refreshed=True), trigger, available_now)


def append_flow(
    name: str, df: DataFrame, cfg: LakeConfig, target: str = SILVER, available_now: bool = True,
    trigger: str = "30 seconds",
) -> StreamingQuery:
    """One of several flows into a shared table: own checkpoint, each batch a load of its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # The write runs the observed plan also for a batch without rows.
        storage.append(batch, cfg, target, f"{name}-b{batch_id:09d}")

    writer = df.writeStream.foreachBatch(write).outputMode("append")
    return start(writer, cfg.checkpoint(name, refreshed=True), trigger, available_now)


PARTIALS = "flow.kpi_partials"


def partials_flow(spark: SparkSession, cfg: LakeConfig, max_files: int | None = None) -> StreamingQuery:
    """Each micro-batch of silver adds its partial KPIs as one load; a replayed batch adds nothing, and no day is read again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        storage.append(partials.kpi_partials(batch, cast_day=False), cfg, PARTIALS, f"kpi_partials-b{batch_id:09d}")

    writer = storage.stream_table(spark, cfg, SILVER, max_files).writeStream.foreachBatch(write).outputMode("append")
    return start(writer, cfg.checkpoint("kpi_partials", refreshed=True), available_now=True)


class Totals(StreamingQueryListener):
    """Observed metrics of every micro-batch, summed as the batches end; a query itself only remembers its last ones."""

    def __init__(self) -> None:
        self._sums: dict[str, FlowReport] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _of(self, run: str) -> tuple[FlowReport, threading.Event]:
        with self._lock:
            return self._sums.setdefault(run, FlowReport()), self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        sums, _ = self._of(str(event.progress.runId))
        for dataset, row in (event.progress.observedMetrics or {}).items():
            sums.add(dataset, row.asDict())

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._of(str(event.runId))[1].set()

    def take(self, query: StreamingQuery, seconds: float = 120) -> FlowReport:
        """All metrics of a query that has ended; events come in order, its end last."""
        sums, ended = self._of(str(query.runId))
        if not ended.wait(seconds):
            raise RuntimeError(f"the metrics of {query.name or query.id} are incomplete")
        return sums


def run_flows(flows: list[Flow], report: FlowReport | None = None) -> FlowReport:
    """Run flows side by side to their end; one that fails does not stop the others."""
    totals, streams = Totals(), SparkSession.active().streams
    streams.addListener(totals)
    try:
        return _run_flows(flows, report or FlowReport(), totals)
    finally:
        streams.removeListener(totals)


def _run_flows(flows: list[Flow], report: FlowReport, totals: Totals) -> FlowReport:
    running = []
    for flow in flows:
        try:
            running.append((flow.name, flow.start()))
        except Exception as error:  # noqa: BLE001 - reported, the other flows go on
            report.failures[flow.name] = str(error)
    for name, query in running:
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            report.failures[name] = str(error)
        for dataset, values in totals.take(query).metrics.items():
            report.add(dataset, values)
    return report


def log_metrics(spark: SparkSession, cfg: LakeConfig, report: FlowReport) -> None:
    """Expectation counts to the run log: one row per dataset and rule, and one with the rows checked."""
    run = uuid.uuid4().hex
    rows = [
        storage.run_row(spark, "expectation", run, F.current_timestamp(), "SUCCESS", n, None, f"{dataset}.{rule}")
        for dataset, values in report.metrics.items() for rule, n in values.items()
    ]
    if rows:
        storage.log_runs(union_all(rows), cfg)


def bronze_flows(spark: SparkSession, cfg: LakeConfig, max_files: int | None = None) -> list[Flow]:
    """Both bronze datasets: stored rows with a processing time, violations counted."""
    def shaped(source: str, target: str, rules: Mapping[str, str]) -> Flow:
        def go() -> StreamingQuery:
            rows = stamp(storage.stream_table(spark, cfg, source, max_files), "processing_ts")
            return single_writer_stream(quality.expect(rows, rules, target), cfg, target)

        return Flow(target, go)

    return [
        shaped("bronze.gtfs_rt_events", "flow.bronze_batch", quality.BRONZE_BATCH_RULES),
        shaped("bronze.eventhub_gtfs_raw", "flow.bronze_hub", quality.BRONZE_HUB_RULES),
    ]


def silver_flows(spark: SparkSession, cfg: LakeConfig, max_files: int | None = None) -> list[Flow]:
    """Both append flows into the silver fact; rows that break a rule are dropped."""
    def fed(name: str, source: str, shape: Callable[[DataFrame], DataFrame]) -> Flow:
        def go() -> StreamingQuery:
            rows = shape(storage.stream_table(spark, cfg, source, max_files))
            checked = quality.expect_or_drop(rows, quality.SILVER_FACT_RULES, name)
            return append_flow(name, checked, cfg)

        return Flow(name, go)

    return [
        fed("batch_to_silver", "flow.bronze_batch", silver_from_batch),
        fed("hub_to_silver", "flow.bronze_hub", lambda df: silver_from_hub(parse_hub(df))),
    ]


def refresh(
    spark: SparkSession, cfg: LakeConfig, name: str, build: Callable[[], DataFrame],
    rules: Mapping[str, str] | None = None, report: FlowReport | None = None,
) -> int:
    """Recompute a materialized dataset as a new version, counting violations while writing."""
    df = build()
    if not rules:
        return storage.publish(df, cfg, name)
    seen = Observation()
    version = storage.publish(quality.expect(df, rules, seen), cfg, name)
    if report is not None:
        report.add(name, seen.get)
    return version


def run_declarative(
    spark: SparkSession, cfg: LakeConfig, full: bool = False, max_files: int | None = None
) -> tuple[LakeConfig, FlowReport]:
    """All six datasets in dependency order; returns the configuration they are under.

    ``full`` starts a new generation with empty tables and checkpoints; otherwise
    the streams go on where they stopped.  The generation is kept in the lake, so a new
    process goes on with the current one; bronze and silver of the batch variant have none.
    """
    cfg = cfg.at_generation(storage.next_generation(spark, cfg) if full else storage.read_generation(spark, cfg))
    report = run_flows(bronze_flows(spark, cfg, max_files))
    run_flows(silver_flows(spark, cfg, max_files), report)
    refresh(spark, cfg, "flow.silver_dim_route", lambda: quality.expect_or_fail(
        kpi.flow_dim_route(storage.read_table(spark, cfg, "silver.dim_route")), quality.DIM_ROUTE_RULES))
    refresh(spark, cfg, "flow.gold_kpi_daily",
            lambda: kpi.kpi_daily(storage.read_table(spark, cfg, SILVER), cast_p95=False),
            quality.GOLD_KPI_RULES, report)
    refresh(spark, cfg, "flow.gold_kpi_enriched",
            lambda: kpi.enrich_flow(storage.read_table(spark, cfg, "flow.gold_kpi_daily"),
                                    storage.read_table(spark, cfg, "flow.silver_dim_route")),
            quality.GOLD_ENRICHED_RULES, report)
    log_metrics(spark, cfg, report)
    if report.failures:
        raise RuntimeError(f"flows failed: {report.failures}")
    return cfg, report
