"""Keyed upsert as DataFrame algebra.

A key with a NULL never equals anything, so such rows of the target stay and
such rows of the source are added.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def reject_repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail when a non-null key occurs twice: the update would be ambiguous.

    Keys are counted by a partial aggregate, so a hot key sends one row per task.
    """
    message = F.concat_ws(", ", F.lit("several source rows for key"), *[F.col(k).cast("string") for k in keys])
    repeated = source.filter(_has_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    # An empty branch of the union that raises for every repeated key.
    failing = repeated.filter(F.raise_error(message).cast("boolean"))
    shape = {f.name: f.dataType for f in source.schema.fields}
    empty = failing.select(*[(F.col(c) if c in keys else F.lit(None)).cast(t).alias(c) for c, t in shape.items()])
    return source.unionByName(empty)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str] | None = None,
    unique: bool = False,
    null_keys: bool = True,
) -> DataFrame:
    """Target after an upsert by key: one full outer join, each side evaluated once.

    Without ``set_cols`` a matched row is replaced whole; with it only those
    columns change and an unmatched source row is inserted with all columns.
    ``unique`` makes a repeated source key an error.

    A row whose key has a NULL matches nothing.  Such rows are spread over the tasks
    by a hash of the whole row, which is part of the join key and constant for all others.
    ``null_keys=False`` says that there are hardly any: the join is then on the key
    alone and reuses a partitioning that the source already has.
    """
    keys = list(keys)
    source = source.select(*target.columns)
    if unique:
        source = reject_repeated_keys(source, keys)
    changed = target.columns if set_cols is None else list(set_cols)

    def side(df: DataFrame, mark: str, name: str) -> DataFrame:
        spread = F.when(_has_key(keys), F.lit(0).cast("bigint")).otherwise(F.xxhash64(*df.columns))
        return df.withColumns({mark: F.lit(True), "_spread": spread if null_keys else F.lit(0).cast("bigint")}).alias(name)

    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    if null_keys:
        on.append(F.col("t._spread") == F.col("s._spread"))
    joined = side(target, "_in_t", "t").join(side(source, "_in_s", "s"), on, "full_outer")
    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()

    def value(name: str) -> Column:
        from_source = in_s if name in changed else ~in_t
        return F.when(from_source, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name)

    return joined.select(*[value(c) for c in target.columns])


def merge_sql(target: str, source_view: str, keys: Sequence[str], set_cols: Sequence[str] | None = None) -> str:
    """The same upsert as a ``MERGE`` statement for catalogs with row-level writes."""
    match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    change = "*" if set_cols is None else ", ".join(f"t.{c} = s.{c}" for c in set_cols)
    return (
        f"MERGE INTO {target} AS t USING {source_view} AS s ON {match} "
        f"WHEN MATCHED THEN UPDATE SET {change} WHEN NOT MATCHED THEN INSERT *"
    )


def advance_watermark(marks: DataFrame, key: str, new_ts: Column | int, now: Column) -> DataFrame:
    """Control table after moving one source's mark."""
    new_mark = new_ts if isinstance(new_ts, Column) else F.lit(new_ts)
    spark = marks.sparkSession
    row = spark.range(1).select(
        F.lit(key).alias("source_key"),
        new_mark.cast("bigint").alias("last_ts"),
        now.cast("timestamp").alias("updated_at"),
    )
    return upsert(marks, row, ["source_key"])


def append_if_absent(df: DataFrame, target: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """Rows of ``df`` whose date the target does not hold yet."""
    return df.join(target.select(date_col).distinct(), date_col, "left_anti").select(*df.columns)
