"""Daily KPIs as stored partial results that add up: a micro-batch adds rows and never reads a day again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import kpi_date, kpi_date_by_text
from delaylake.operators.facts import valid_only

# Values a sketch keeps before it thins them out: exact up to about as many, a rank error near 0.1 % beyond.
SKETCH_K = 4096


def kpi_partials(fact: DataFrame, cast_day: bool = True) -> DataFrame:
    """(kpi_date, route_id, events, delays, delay_sum, sketch) of valid rows.

    Count, sum and sketch are each mergeable, within a task, between tasks and later between
    stored loads; NULL delays count as events only.
    """
    day = kpi_date() if cast_day else kpi_date_by_text()
    return valid_only(fact).withColumn("kpi_date", day).groupBy("kpi_date", "route_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count("delay_sec").alias("delays"),
        F.sum(F.col("delay_sec").cast("long")).alias("delay_sum"),
        F.kll_sketch_agg_bigint(F.col("delay_sec").cast("long"), SKETCH_K).alias("sketch"),
    )


def kpi_from_partials(partials: DataFrame, percentile: float = 0.95) -> DataFrame:
    """Count, mean and percentile of the delay by (day, route) from any number of partial rows.

    Count and mean equal a rebuild from the events; the percentile is an element whose rank is
    off by the sketch's error, nothing for groups that fit the sketch.
    """
    merged = partials.groupBy("kpi_date", "route_id").agg(
        F.sum("events").alias("trip_update_cnt"),
        F.sum("delays").alias("delays"),
        F.sum("delay_sum").alias("delay_sum"),
        F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"),
    )
    known = F.col("delays") > 0
    quantile = F.kll_sketch_get_quantile_bigint("sketch", F.lit(percentile))
    return merged.select(
        "kpi_date", "route_id", "trip_update_cnt",
        F.when(known, F.col("delay_sum").cast("double") / F.col("delays")).alias("avg_delay_sec"),
        F.when(known, quantile).cast("int").alias("p95_delay_sec"),
    )
