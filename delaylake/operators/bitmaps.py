"""Exact distinct counts that add up: one bitmap a day, joined by OR to any period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hash groups that number their values apart; a power of two well under the bits of a bitmap.
GROUPS = 256
PERIODS = ("day", "week", "month", "all")


def numbered(values: DataFrame, key: str) -> DataFrame:
    """(key, number): every distinct value that is not NULL and a number of its own, from 0 with few gaps.

    Values are numbered inside hash groups, so that no one task orders all of them.
    """
    distinct = values.select(key).filter(F.col(key).isNotNull()).distinct()
    group = F.pmod(F.xxhash64(key), F.lit(GROUPS))
    place = F.row_number().over(Window.partitionBy("g").orderBy(key)) - 1
    return distinct.withColumn("g", group).select(key, (place.cast("long") * GROUPS + F.col("g")).alias("number"))


def day_bitmaps(rows: DataFrame, numbers: DataFrame, key: str, day: Column) -> DataFrame:
    """(day, bucket, bits): which numbers occur on each day.  NULL keys and days take no part."""
    # Repeated (day, key) rows go before the numbers are looked up, so a hot key is one row a task.
    seen = rows.select(day.alias("day"), key).filter(F.col(key).isNotNull() & F.col("day").isNotNull()).distinct()
    held = seen.join(numbers, key)
    return held.groupBy("day", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def distinct_by_period(bitmaps: DataFrame, periods: Sequence[str] = PERIODS) -> DataFrame:
    """(period, start, distinct_keys): exact distinct counts of every day, week, month, year or of all days.

    Reads the day bitmaps once; weeks begin on Monday, and ``all`` begins at the first day.
    """
    def begin(p: str) -> Column:
        at = F.lit(None).cast("date") if p == "all" else F.trunc("day", p) if p != "day" else F.col("day")
        return F.struct(F.lit(p).alias("period"), at.alias("start"))

    spread = bitmaps.select("day", "bucket", "bits", F.explode(F.array(*[begin(p) for p in periods])).alias("p"))
    joined = spread.groupBy("p", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.min("day").alias("first"))
    counted = joined.groupBy("p").agg(F.sum(F.bitmap_count("bits")).alias("distinct_keys"), F.min("first").alias("first"))
    return counted.select("p.period", F.coalesce("p.start", "first").alias("start"), "distinct_keys")
