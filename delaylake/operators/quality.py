"""Expectations: warn, drop or fail; violations are counted in the same pass.

A rule is SQL text; a rule that yields NULL counts as violated.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from delaylake import fixed_values as fv

Rules = Mapping[str, str]

# The rules of the datasets.
BRONZE_BATCH_RULES = {
    "valid_id": "id IS NOT NULL",
    "valid_route_id": "route_id IS NOT NULL",
    "has_timestamp": "trip_update_timestamp IS NOT NULL OR ingested_at IS NOT NULL",
}
BRONZE_HUB_RULES = {
    "has_payload": "payload IS NOT NULL",
    "has_enqueued_time": "enqueued_time IS NOT NULL",
}
SILVER_FACT_RULES = {
    "valid_route_id": "route_id IS NOT NULL",
    "valid_trip_id": "trip_id IS NOT NULL",
    "reasonable_delay":
        f"delay_sec IS NULL OR (delay_sec BETWEEN {fv.DELAY_MIN_SEC} AND {fv.DELAY_MAX_SEC})",
    "has_event_time": "event_ts IS NOT NULL",
}
DIM_ROUTE_RULES = {
    "valid_route_id": "route_id IS NOT NULL",
    "has_route_name": "route_short_name IS NOT NULL OR route_long_name IS NOT NULL",
}
GOLD_KPI_RULES = {
    "valid_kpi_date": "kpi_date IS NOT NULL",
    "valid_route": "route_id IS NOT NULL",
    "positive_trip_count": "trip_update_cnt > 0",
}
GOLD_ENRICHED_RULES = {"has_route_name": "route_short_name IS NOT NULL"}


def _holds(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def _counters(rules: Rules) -> list[Column]:
    total = F.count(F.lit(1)).alias("rows")
    return [total] + [F.count_if(~_holds(rule)).alias(name) for name, rule in rules.items()]


def expect(df: DataFrame, rules: Rules, observation: Observation | str) -> DataFrame:
    """Warn: all rows pass; rows and violations per rule go to the observation.

    On a stream pass a name and read the metrics from the query's progress.
    """
    return df.observe(observation, *_counters(rules))


def expect_or_drop(df: DataFrame, rules: Rules, observation: Observation | str | None = None) -> DataFrame:
    """Drop rows that violate any rule, counting before the drop."""
    counted = df if observation is None else expect(df, rules, observation)
    return counted.filter(reduce(lambda a, b: a & b, [_holds(r) for r in rules.values()]))


def expect_or_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """Abort on the first violation.

    The error is raised inside a filter: a checking column could be pruned.
    """
    def check(name: str, rule: str) -> Column:
        failure = F.raise_error(F.lit(f"expectation {name} violated")).cast("boolean")
        return F.when(_holds(rule), F.lit(True)).otherwise(failure)

    return df.filter(reduce(lambda a, b: a & b, [check(n, r) for n, r in rules.items()]))


def violation_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with its number of violations, from one pass."""
    pairs = ", ".join(f"'{name}', `{name}`" for name in rules)
    counted = df.agg(*_counters(rules))
    return counted.selectExpr(
        f"stack({len(rules)}, {pairs}) AS (rule, violations)", "rows AS checked_rows"
    )


def quality_profile(fact: DataFrame) -> DataFrame:
    """Totals, valid share, routes, rows with a delay, rows without a time."""
    valid = F.count_if("is_valid")
    return fact.agg(
        F.count(F.lit(1)).alias("total_events"),
        valid.alias("valid_events"),
        F.count_if(~F.col("is_valid")).alias("invalid_events"),
        F.round(F.try_divide(valid * 100.0, F.count(F.lit(1))), 2).cast("double").alias("valid_pct"),
        F.count_distinct("route_id").alias("distinct_routes"),
        F.count("delay_sec").alias("has_delay_cnt"),
        F.count_if(F.col("event_ts").isNull()).alias("null_event_ts"),
    )


def quality_status(profile: DataFrame, min_pct: float = fv.MIN_VALID_PCT) -> DataFrame:
    """OK, LOW or EMPTY (a table without rows has no valid share)."""
    status = (
        F.when(F.col("valid_pct").isNull(), "EMPTY")
        .when(F.col("valid_pct") < min_pct, "LOW")
        .otherwise("OK")
    )
    return profile.select("valid_pct", status.alias("status"))
