"""Database export of the reporting tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from delaylake import storage
from delaylake.config import LakeConfig
from delaylake.operators.routes import active_routes
from delaylake.plans.medallion import DIM, GOLD, enriched_kpi
from delaylake.sources.jdbc import jdbc_overwrite, verify_export


def export_frames(spark: SparkSession, cfg: LakeConfig) -> dict[str, DataFrame]:
    """What goes out, by database table: KPIs, active routes, enriched KPIs."""
    return {
        "route_delay_kpi_daily": storage.read_table(spark, cfg, GOLD),
        "dim_route": active_routes(storage.read_table(spark, cfg, DIM)),
        "route_delay_kpi_enriched": enriched_kpi(spark, cfg),
    }


def export_all(
    spark: SparkSession, cfg: LakeConfig, jdbc: Mapping[str, str], schema: str = "dbo", truncate: bool = False
) -> DataFrame:
    """Replace the three database tables and count them there."""
    frames = {f"{schema}.{t}": df for t, df in export_frames(spark, cfg).items()}
    for table, df in frames.items():
        jdbc_overwrite(df, jdbc, table, truncate=truncate)
    return verify_export(spark, jdbc, list(frames))
