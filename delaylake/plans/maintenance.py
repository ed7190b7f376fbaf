"""Layout jobs: compaction, clustering, statistics, table details."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from delaylake import storage
from delaylake.config import TABLES, LakeConfig
from delaylake.operators.combine import union_all

MAINTAINED = (
    "bronze.gtfs_rt_events", "bronze.eventhub_gtfs_raw", "bronze.dim_route_ref",
    "bronze._cosmos_watermarks", "silver.fact_trip_delay_event", "silver.dim_route",
    "gold.route_delay_kpi_daily",
)


def _files(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame | None:
    """Listing of the current files; names and sizes only, contents are not read."""
    now = storage.state(spark, cfg, name)
    dirs = list(now.dirs)
    if cfg.spec(name).kind == "loads":
        dirs += [f"load_id={i}" for i in storage.load_ids(spark, cfg, name) if i not in set(now.covers)]
    if not dirs:
        return None
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true").load([f"{cfg.path(name)}/{d}" for d in dirs])
        .select("path", "length", "modificationTime")
    )


def table_detail(spark: SparkSession, cfg: LakeConfig, names: Sequence[str] = MAINTAINED) -> DataFrame:
    """Files, size, clustering columns and last change of each table that has data."""
    rows = []
    for name in names:
        files = _files(spark, cfg, name)
        if files is None:
            continue
        keys = TABLES[name].cluster_by
        detail = files.agg(
            F.count(F.lit(1)).alias("num_files"),
            F.round(F.coalesce(F.sum("length"), F.lit(0)) / 1048576, 2).alias("size_mb"),
            F.max("modificationTime").alias("last_modified"),
        ).select(F.lit(name).alias("table"), F.lit("parquet").alias("format"), "*")
        if keys:
            detail = detail.withColumn("clustering_columns", F.array(*[F.lit(k) for k in keys]))
        rows.append(detail)
    return union_all(rows, allow_missing=True)


def _target_files(spark: SparkSession, cfg: LakeConfig, name: str, target_mb: int) -> int:
    files = _files(spark, cfg, name)
    size = 0 if files is None else files.agg(F.sum("length")).first()[0] or 0
    return max(1, math.ceil(size / (target_mb * 1048576)))


def _republish(
    spark: SparkSession, cfg: LakeConfig, name: str, df: DataFrame, operation: str, at: storage.Snapshot
) -> int:
    # Covered is what the snapshot read; a load placed since then stays a load of its own.
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    version = storage.publish(counted, cfg, name, covers=at.loads, arranged=True)
    storage.log_commit(spark, cfg, name, version, operation, seen.get["rows"])
    return version


def compact(spark: SparkSession, cfg: LakeConfig, name: str, target_mb: int = 256) -> int:
    """Rewrite a table into files of about the target size; same rows.

    A partitioned table is arranged by its partition column first; its large
    partitions are still spread over many tasks.
    """
    n = _target_files(spark, cfg, name, target_mb)
    at = storage.snapshot(spark, cfg, name)
    df, column = storage.read_stored(spark, cfg, name, at), cfg.spec(name).partition_by
    if column:
        # Range bounds over (partition, key) give even files even for one huge day.
        keys = [column, *cfg.spec(name).cluster_by]
        return _republish(spark, cfg, name, df.repartitionByRange(n, *keys), "OPTIMIZE", at)
    return _republish(spark, cfg, name, df.repartition(n), "OPTIMIZE", at)


def cluster(
    spark: SparkSession, cfg: LakeConfig, name: str, keys: Sequence[str] | None = None, target_mb: int = 256
) -> int:
    """Rewrite a table sorted by its clustering keys, so that Parquet min/max skip files.

    Ranges are cut on all keys together: a route that holds a third of the rows
    is split by its second key.
    """
    spec = cfg.spec(name)
    keys = list(keys or spec.cluster_by)
    if spec.partition_by:
        keys = [spec.partition_by, *keys]
    n = _target_files(spark, cfg, name, target_mb)
    at = storage.snapshot(spark, cfg, name)
    df = storage.read_stored(spark, cfg, name, at)
    ordered = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return _republish(spark, cfg, name, ordered, "CLUSTER", at)


def analyze(spark: SparkSession, cfg: LakeConfig, name: str, columns: Sequence[str] = ()) -> str:
    """Optimizer statistics of a compacted table, in the session catalog; returns its name there."""
    if cfg.sql_catalog:
        table = cfg.sql_name(name)
    else:
        dirs = storage.state(spark, cfg, name).dirs
        homes = {d.split(f"/{cfg.spec(name).partition_by}=")[0] for d in dirs}
        if len(homes) != 1:
            raise ValueError(f"{name} lies in {len(homes)} versions; compact it first")
        table = f"`{cfg.catalog}_{name.replace('.', '_')}`"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{cfg.path(name)}/{homes.pop()}'")
        if cfg.spec(name).partition_by:
            spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    return table


def run_maintenance(spark: SparkSession, cfg: LakeConfig, names: Sequence[str] = MAINTAINED) -> DataFrame:
    """Cluster the large tables, compact the others, refresh statistics, report."""
    for name in names:
        if _files(spark, cfg, name) is None:
            continue
        if cfg.spec(name).cluster_by:
            cluster(spark, cfg, name)
        else:
            compact(spark, cfg, name)
        analyze(spark, cfg, name)
    return table_detail(spark, cfg, names)
