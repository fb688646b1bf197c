"""Connected components of an undirected graph, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): for every node with an edge, the smallest node it is joined to.

    Self-loops and repeated edges don't matter; edges with a null end are left out; no edges give no rows.
    Each round links every node to the least of its neighbourhood and re-hangs the others there; the
    number of rounds grows with the logarithm of the largest component's size. Lineage is cut every round in the shared
    checkpoint folder. Only a count and a checksum of the edges reach the driver.
    """
    own = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u is not null and v is not null")
    now = cut(own.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        now = cut(_small_star(_large_star(now)))
    nodes = own.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return nodes.join(now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are hung on the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
