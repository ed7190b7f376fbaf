"""What the operators of this package share: cutting lineage in the shared folder, and temporary column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset one under the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_shared"


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder; a lost executor then costs a read, not a recomputation.

    Nothing reads the shuffle files of the frame after that, so Spark is told to remove them; the session's own setting is put back.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        # The setting holds for frames made under it.
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of the frame has it (names clash without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """A column by its exact name, also if that has dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def hashable(df: DataFrame) -> list[Column]:
    """All columns that xxhash64 takes; maps and variants are left out."""
    return [col(f.name) for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant", "void"))]
