"""Connected components of a graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to the least node it knows."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(least, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; a component is named by its least node.

    links: (u, v) of longs without nulls; self-links and repeats do no harm.  Rounds grow with the logarithm of the
    graph; each ends in a checkpoint, and what a round gathers per node is a minimum, combined before the shuffle.
    """
    edges = checkpointed(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                         .distinct())
    state = None
    while True:
        edges = checkpointed(small_star(large_star(edges)))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())
