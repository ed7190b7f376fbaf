"""Relational database reads and exports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.operators.combine import union_all


def jdbc_read(spark: SparkSession, opts: Mapping[str, str], table: str) -> DataFrame:
    """A database table.

    For a large one give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` in ``opts``; without them one connection reads it all.
    """
    return spark.read.format("jdbc").options(**opts).option("dbtable", table).load()


def jdbc_overwrite(
    df: DataFrame, opts: Mapping[str, str], table: str, connections: int = 8, truncate: bool = False
) -> None:
    """Replace a database table; ``truncate`` keeps its definition and grants.

    ``connections`` bounds the parallel writers, so that a wide plan does not
    open one connection per task.
    """
    (
        df.write.format("jdbc").options(**opts).option("dbtable", table)
        .option("numPartitions", connections).option("truncate", str(truncate).lower())
        .mode("overwrite").save()
    )


def verify_export(spark: SparkSession, opts: Mapping[str, str], tables: list[str]) -> DataFrame:
    """Row count of each exported table and a total row."""
    counts = union_all([
        # The count runs in the database; one row per table comes back.
        jdbc_read(spark, opts, f"(SELECT COUNT(*) AS row_count FROM {t}) q")
        .select(F.lit(t).alias("table_name"), F.col("row_count").cast("bigint").alias("row_count"))
        for t in tables
    ])
    return counts.rollup("table_name").agg(F.sum("row_count").alias("row_count")).select(
        F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "row_count"
    )
