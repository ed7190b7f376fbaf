"""Connected components of links by minimum labels and pointer jumping, entirely in shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm.shared import cut


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) to (id, comp): comp is the smallest id reachable over the links. No links give an empty result.

    Each turn replaces links by links to smaller nodes: every node points to its smallest neighbour, and its other neighbours
    to that one (large star, then small star), until the links are stars apart from each other. Hubs are aggregated before they are joined.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    while not are_stars(edges):
        # Large star: larger neighbours of a node move to its smallest neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = cut(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())


def are_stars(edges: DataFrame) -> bool:
    """Whether every node has one link to a smaller one, or only links from larger ones; then nothing is left to move."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up = 1 AND down = 1").isEmpty()
