"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (u, v) with u > v; a hub's edges are split over tasks.

    Each node's least neighbour is a partial aggregate; it is written before
    the join, so that both sides of the join are plain exchanges, which AQE
    can split at a hub.
    """
    ways = edges.select("u", "v")
    if large:
        ways = ways.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
                        .withColumnRenamed("u", "c"), "least")
    joined = ways.join(least, ways["u"] == least["c"])
    if large:
        out = joined.where("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.where("c > m").select(F.col("c").alias("u"), F.col("m").alias("v")))
    return materialize(out.distinct(), "stars")


def _is_star_forest(edges: DataFrame) -> bool:
    """True if each node is either a root (v) or the child (u) of one root."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("root")))
    sums = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("root").alias("root"))
    return sums.where("child + root > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (columns u, v of long): the least node reachable.

    Ends when every component is a star around its least node; the number of
    rounds grows with the logarithm of the components' diameter.
    """
    edges = materialize(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "links")
    while not _is_star_forest(edges):
        edges = _stars(_stars(edges, large=True), large=False)
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
