"""Route dimension: reference first, then the fixed mapping, then the id itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake import fixed_values as fv
from delaylake import schemas
from delaylake.functions import parse_json, route_type_label
from delaylake.operators.ranking import latest_per_route

ATTRIBUTES = ("route_id", "route_short_name", "route_long_name", "route_type")


def fallback_routes(spark: SparkSession) -> DataFrame:
    """The fixed mapping as a frame of 27 rows."""
    rows = spark.createDataFrame(
        fv.FALLBACK_ROUTES,
        "route_id string, route_short_name string, route_long_name string, route_type string",
    )
    # A literal, so its broadcast cannot grow; other mappings are left to AQE.
    return F.broadcast(rows)


def latest_routes(ref: DataFrame) -> DataFrame:
    """Attributes of each route from its newest reference snapshot."""
    doc = parse_json("payload", schemas.REFERENCE_TEXT)
    return latest_per_route(ref).select("route_id", doc.alias("r")).select(
        "route_id",
        F.col("r.route_short_name").alias("route_short_name"),
        F.col("r.route_long_name").alias("route_long_name"),
        route_type_label("r.route_type").alias("route_type"),
    )


def non_null(df: DataFrame, col: str = "route_id") -> DataFrame:
    """Rows whose key is present."""
    return df.filter(F.col(col).isNotNull())


def routes_seen(bronze: DataFrame) -> DataFrame:
    """Distinct non-null routes of the facts."""
    return non_null(bronze.select("route_id")).distinct()


def first_seen(bronze: DataFrame) -> DataFrame:
    """Day each route was first ingested, the NULL route included."""
    return bronze.groupBy("route_id").agg(F.min("ingested_at").cast("date").alias("effective_from"))


def fact_only_routes(bronze: DataFrame, ref_routes: DataFrame) -> DataFrame:
    """Routes of the facts that the reference lacks."""
    return routes_seen(bronze).join(ref_routes.select("route_id"), "route_id", "left_anti")


def with_fallback(routes: DataFrame, fallback: DataFrame) -> DataFrame:
    """Attributes from the mapping; short name defaults to the id, type to UNKNOWN."""
    joined = routes.join(fallback, "route_id", "left")
    return joined.select(
        "route_id",
        F.coalesce("route_short_name", "route_id").alias("route_short_name"),
        "route_long_name",
        F.coalesce("route_type", F.lit(fv.ROUTE_TYPE_UNKNOWN)).alias("route_type"),
    )


def resolve_routes(bronze: DataFrame, ref: DataFrame, fallback: DataFrame) -> DataFrame:
    """Every route with its attributes; an empty reference leaves the other two tiers."""
    ref_routes = latest_routes(ref)
    others = with_fallback(fact_only_routes(bronze, ref_routes), fallback)
    return ref_routes.unionByName(others)


def with_first_seen(routes: DataFrame, bronze: DataFrame, today: Column) -> DataFrame:
    """Active dimension rows: start on the first day seen, else today; no end."""
    return _active(routes.join(first_seen(bronze), "route_id", "left"), today)


def dim_route(bronze: DataFrame, ref: DataFrame, fallback: DataFrame, today: Column) -> DataFrame:
    """``with_first_seen(resolve_routes(...))`` with a single pass over the facts.

    The facts are reduced once to (route, first day); a full outer join with the
    reference then shows which tier each route belongs to.
    """
    seen = non_null(first_seen(bronze))
    tiers = latest_routes(ref).withColumn("_listed", F.lit(True)).join(seen, "route_id", "full_outer")
    mapped = fallback.select("route_id", *[F.col(c).alias(f"_f_{c}") for c in ATTRIBUTES[1:]])
    joined = tiers.join(mapped, "route_id", "left")

    def pick(name: str, default: Column) -> Column:
        other = F.coalesce(F.col(f"_f_{name}"), default)
        return F.when(F.col("_listed").isNotNull(), F.col(name)).otherwise(other).alias(name)

    named = joined.select(
        "route_id",
        pick("route_short_name", F.col("route_id")),
        pick("route_long_name", F.lit(None).cast("string")),
        pick("route_type", F.lit(fv.ROUTE_TYPE_UNKNOWN)),
        "effective_from",
    )
    return _active(named, today)


def _active(routes: DataFrame, today: Column) -> DataFrame:
    return routes.select(
        *ATTRIBUTES,
        F.coalesce(F.col("effective_from"), today.cast("date")).alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
    )


def active_routes(dim: DataFrame) -> DataFrame:
    """Dimension rows without an end date."""
    return dim.filter(F.col("effective_to").isNull())


def scd1_upsert(dim: DataFrame, staged: DataFrame) -> DataFrame:
    """Overwrite the attributes of known routes, add new ones; no history is kept."""
    from delaylake.operators.upsert import upsert

    return upsert(dim, staged, ["route_id"], [c for c in staged.columns if c != "route_id"])
