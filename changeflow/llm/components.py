"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import written


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, v, m): m is the least of u and its partners. The least is found with partial sums, then joined."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def _step(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _smallest(both).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    small = _smallest(large)
    moved = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(small.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node but the roots has one link, to a root."""
    ends = links.select(F.col("u").alias("x"), F.col("v").alias("y")).union(links.select(F.col("v").alias("x"), F.lit(None).alias("y")))
    nodes = ends.groupBy("x").agg(F.min("y").alias("low"), F.max("y").alias("high"), F.count(F.when(F.col("y").isNull(), 1)).alias("into"))
    return nodes.where("low != high or (low is not null and into > 0)").isEmpty()


def roots(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (u, v) but the roots; a root is its component's least node.

    Each round is written to the shared folder. The rounds end when the links
    are stars; their number grows with the logarithm of the component size.
    """
    u, v = F.greatest("u", "v"), F.least("u", "v")
    now = written(links.where("u != v").select(u.alias("u"), v.alias("v")).distinct(), "links")
    while not _are_stars(now):
        now = written(_step(now), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
