"""Connected components by alternating large-star and small-star, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthloom.llm.common import stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Links each neighbour above a node to the node's least neighbour, itself counted; at most a row a link, repeats left in."""
    both = _both(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its neighbours below it to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    kept = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return kept.union(least.select("u", F.col("m").alias("v"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node has at most one link to a lesser node, and that node has none: finished components."""
    ends = edges.select("u", F.lit(1).alias("down")).union(edges.select(F.col("v").alias("u"), F.lit(0).alias("down")))
    told = ends.groupBy("u").agg(F.sum("down").alias("down"), F.min("down").alias("lower"))
    return told.where("down > 1 or (down > 0 and lower = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """From links (u, v) of integers to (node, component), the component its least node.

    Nodes without links are not in the result. Every round is written to the shared folder; rounds
    end when the links are stars around least nodes.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not _stars(now):
        now = stored(small_star(large_star(now)), "links")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
