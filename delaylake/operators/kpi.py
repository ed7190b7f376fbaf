"""Daily delay KPIs per route and the reports over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import delay_label, hour_utc, kpi_date, kpi_date_by_text
from delaylake.operators.facts import valid_only
from delaylake.operators.routes import active_routes


def kpi_daily(fact: DataFrame, cast_p95: bool = True) -> DataFrame:
    """Count, mean and 95th percentile of the delay by (day, route), valid rows only.

    The percentile is an element of the group, from mergeable sketches, so each
    task sends one partial row per group however hot the group is.  The
    declarative variant (``cast_p95=False``) keeps the integer type.
    """
    day = kpi_date() if cast_p95 else kpi_date_by_text()
    p95 = F.percentile_approx("delay_sec", 0.95)
    keys = ("kpi_date", "route_id") if cast_p95 else ("route_id", "kpi_date")
    return valid_only(fact).withColumn("kpi_date", day).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trip_update_cnt"),
        F.avg("delay_sec").alias("avg_delay_sec"),
        (p95.cast("double") if cast_p95 else p95).alias("p95_delay_sec"),
    )


_ENRICHED = (
    "kpi_date", "route_id", "route_short_name", "route_long_name", "route_type",
    "trip_update_cnt", "avg_delay_sec", "p95_delay_sec",
)


def enrich(kpi: DataFrame, dim: DataFrame) -> DataFrame:
    """KPI rows with the names of the active route version; every KPI row survives."""
    k, d = kpi.alias("k"), dim.alias("d")
    on = (F.col("k.route_id") == F.col("d.route_id")) & F.col("d.effective_to").isNull()
    return k.join(d, on, "left").select(
        "k.kpi_date", "k.route_id", "d.route_short_name", "d.route_long_name", "d.route_type",
        "k.trip_update_cnt", "k.avg_delay_sec", "k.p95_delay_sec",
    )


def enrich_flow(kpi: DataFrame, active_dim: DataFrame) -> DataFrame:
    """The declarative join: by column name, on a dimension already cut to active rows."""
    return kpi.join(active_dim, "route_id", "left").select(*_ENRICHED)


def flow_dim_route(dim: DataFrame) -> DataFrame:
    """The declarative dimension: active rows of the stored one."""
    return active_routes(dim.select(
        "route_id", "route_short_name", "route_long_name", "route_type",
        "effective_from", "effective_to",
    ))


def daily_summary(kpi: DataFrame) -> DataFrame:
    """Totals over routes by day; the mean is over routes, not weighted by events."""
    return kpi.groupBy("kpi_date").agg(
        F.count_distinct("route_id").alias("routes_active"),
        F.sum("trip_update_cnt").alias("total_trip_updates"),
        F.round(F.avg("avg_delay_sec"), 1).alias("overall_avg_delay_sec"),
    )


def active_route_count(kpi: DataFrame) -> DataFrame:
    """Exact number of routes with KPIs."""
    return kpi.agg(F.count_distinct("route_id").alias("active_routes"))


def total_updates(enriched: DataFrame) -> DataFrame:
    """All trip updates."""
    return enriched.agg(F.sum("trip_update_cnt").alias("total_updates"))


def latest_date(enriched: DataFrame) -> DataFrame:
    """Newest KPI day."""
    return enriched.agg(F.max("kpi_date").alias("latest_date"))


def updates_by_route(enriched: DataFrame) -> DataFrame:
    """Trip updates by route name."""
    return enriched.groupBy("route_short_name").agg(F.sum("trip_update_cnt").alias("trip_updates"))


def hourly_volume(fact: DataFrame) -> DataFrame:
    """Valid events with a key, by route and hour of day."""
    return valid_only(fact).groupBy("route_id", hour_utc().alias("hour_utc")).agg(
        F.count("event_sk").alias("events")
    )


def route_detail(enriched: DataFrame) -> DataFrame:
    """Trip updates grouped by route names and by the two formatted delays."""
    return enriched.groupBy(
        "route_short_name", "route_long_name", "route_type",
        delay_label("avg_delay_sec").alias("avg_delay"),
        delay_label("p95_delay_sec").alias("p95_delay"),
    ).agg(F.sum("trip_update_cnt").alias("trip_updates"))
