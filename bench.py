"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake import fixed_values as fv
from delaylake.contract.queries import QUERIES
from delaylake.operators import facts, kpi, ranking
from delaylake.operators.upsert import upsert
from delaylake.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delay event per line item: route = supplier, delay = days from order to ship."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.col("l_suppkey").cast("string").alias("route_id"),
        F.col("l_partkey").cast("string").alias("trip_id"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("trip_update_timestamp"),
        F.datediff("l_shipdate", "o_orderdate").alias("first_stop_delay_sec"),
        F.col("l_returnflag").alias("ingest_batch_id"),
        F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
        F.lit(fv.TAG_BATCH).alias("_source"),
    )


def bench_queries() -> dict:
    """Scale queries on the shipments, then the pipeline's own on the events."""
    def ship_dedup(spark, d):
        return ranking.dedup_latest(shipments(spark, d))

    def ship_kpi(spark, d):
        return kpi.kpi_daily(facts.to_silver(shipments(spark, d)))

    def ship_pipeline(spark, d):
        return kpi.kpi_daily(facts.to_silver(ranking.dedup_latest(shipments(spark, d))))

    def ship_upsert(spark, d):
        rows = facts.to_silver(ranking.dedup_latest(shipments(spark, d)))
        changed = rows.filter(F.col("event_ts") >= "2000-01-01")
        return upsert(rows, changed.withColumn("delay_sec", F.col("delay_sec") + 1), ["event_sk"])

    def ship_by_route(spark, d):
        return facts.fact_by_route(facts.to_silver(shipments(spark, d)))

    named = (
        "parse_hub", "trip_docs", "flatten_docs", "dedup_latest", "silver_fact", "silver_flows", "upsert_all",
        "dim_route", "kpi_daily", "kpi_daily_flow", "kpi_enriched", "hourly_volume", "route_detail",
        "quality_profile", "freshness", "dedup_repeated_keys",
    )
    scale = {f.__name__: f for f in (ship_dedup, ship_kpi, ship_pipeline, ship_upsert, ship_by_route)}
    return {**scale, **{n: QUERIES[n] for n in named}}


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__sql__shuffle__partitions=CPUS,
        spark__log__level="ERROR",
    )
    only = sys.argv[1:]
    times = {}
    for name, query in bench_queries().items():
        if only and name not in only:
            continue
        taken = []
        for _ in range(RUNS + 1):
            t0 = time.perf_counter()
            query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - t0)
        # The first run pays for class loading and code generation.
        times[name] = round(statistics.median(taken[1:]), 3)
        print(name, [round(t, 3) for t in taken], file=sys.stderr)
    print(json.dumps({
        "metric": "headline queries, total of medians", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
