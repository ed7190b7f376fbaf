"""Where tables live.  Every read and write goes through a ``LakeConfig``."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from delaylake import schemas


@dataclass(frozen=True)
class TableSpec:
    """A stored table.

    ``kind`` is ``loads`` (append only, one directory per load), ``versions``
    (replaced as a whole or by partition, current state named by a pointer file)
    or ``stream`` (written by one file sink).  ``partition_by`` is a date column
    and ``hidden`` further columns that are stored but not part of the contract.
    """

    name: str
    schema: StructType
    kind: str
    partition_by: str | None = None
    hidden: StructType = StructType()
    cluster_by: tuple[str, ...] = ()
    ts_col: str | None = None
    stale_hours: int | None = None


# Table names, clustering keys and staleness limits (hours).
TABLES = {
    t.name: t
    for t in (
        TableSpec("bronze.gtfs_rt_events", schemas.BRONZE_EVENTS, "loads",
                  cluster_by=("route_id", "ingested_at"), ts_col="lake_ingest_ts", stale_hours=24),
        TableSpec("bronze.eventhub_gtfs_raw", schemas.BRONZE_HUB, "loads",
                  cluster_by=("enqueued_time",), ts_col="bronze_ingest_ts", stale_hours=2),
        TableSpec("bronze.dim_route_ref", schemas.BRONZE_ROUTE_REF, "loads",
                  ts_col="ingested_at", stale_hours=168),
        TableSpec("bronze._cosmos_watermarks", schemas.WATERMARKS, "versions"),
        TableSpec("silver.fact_trip_delay_event", schemas.SILVER_FACT, "versions",
                  partition_by="event_date", hidden=schemas.SILVER_FACT_ORDER, cluster_by=("route_id", "event_ts"),
                  ts_col="event_ts", stale_hours=24),
        TableSpec("silver.dim_route", schemas.SILVER_DIM_ROUTE, "versions"),
        TableSpec("gold.route_delay_kpi_daily", schemas.GOLD_KPI, "versions",
                  ts_col="kpi_date", stale_hours=48),
        TableSpec("docs.gtfs_rt_batch", schemas.DOC_STORE, "loads"),
        TableSpec("docs.gtfs_rt_stream", schemas.DOC_STORE, "loads"),
        TableSpec("docs.sent_batches", schemas.SENT_BATCHES, "loads"),
        TableSpec("ops.run_log", schemas.RUN_LOG, "loads"),
        TableSpec("ops.commit_log", schemas.COMMIT_LOG, "loads"),
        TableSpec("ops.changed_days", schemas.CHANGED_DAYS, "loads"),
        TableSpec("flow.bronze_batch", schemas.FLOW_BRONZE_EVENTS, "stream"),
        TableSpec("flow.bronze_hub", schemas.FLOW_BRONZE_HUB, "stream"),
        TableSpec("flow.silver_fact", schemas.FLOW_SILVER_FACT, "loads"),
        TableSpec("flow.silver_dim_route", schemas.SILVER_DIM_ROUTE, "versions"),
        TableSpec("flow.kpi_partials", schemas.KPI_PARTIALS, "loads"),
        TableSpec("flow.gold_kpi_daily", schemas.FLOW_GOLD_KPI, "versions"),
        TableSpec("flow.gold_kpi_enriched", schemas.FLOW_GOLD_ENRICHED, "versions"),
    )
}


@dataclass(frozen=True)
class LakeConfig:
    """``root`` is any Hadoop path; ``catalog`` separates environments under it.

    ``sql_catalog`` names a Spark catalog with row-level operations; when set,
    upserts are sent to it as ``MERGE INTO`` instead of rewriting directories.
    ``generation`` numbers the full refreshes of the declarative tables.
    """

    root: str
    catalog: str = "dev"
    sql_catalog: str | None = None
    generation: int = 0

    def spec(self, name: str) -> TableSpec:
        return TABLES[name]

    def path(self, name: str) -> str:
        layer, table = name.split(".", 1)
        base = f"{self.root}/{self.catalog}/{layer}/{table.lstrip('_')}"
        return f"{base}/g{self.generation}" if layer == "flow" else base

    def checkpoint(self, flow: str, refreshed: bool = False) -> str:
        """``refreshed`` flows start anew with each generation; bronze and silver go on."""
        home = f"{self.root}/{self.catalog}/checkpoints/{flow}"
        return f"{home}/g{self.generation}" if refreshed else home

    def generations(self) -> str:
        """Where the current generation is kept."""
        return f"{self.root}/{self.catalog}/generations"

    def sql_name(self, name: str) -> str:
        layer, table = name.split(".", 1)
        return f"`{self.sql_catalog}`.`{layer}`.`{table}`"

    def at_generation(self, generation: int) -> LakeConfig:
        return replace(self, generation=generation)


def shared_dir(spark: SparkSession, default: str) -> str:
    """The cluster's shared work folder, or ``default`` where none is configured."""
    return spark.conf.get("spark.checkpoint.dir", None) or default
