"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to its least neighbour. Neighbour lists are never
    gathered: the least one is an aggregate that is joined back."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours and itself to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node with an edge; the component is its least node.

    ``edges`` has long columns u, v; their order, repeats and loops don't matter. Two contractions a
    round; the rounds grow with the logarithm of the longest chain, and each is written to the shared folder.
    """
    now = scratch.keep(edges.where("u <> v").select("u", "v").distinct(), "edges")
    seen = None
    while True:
        after = scratch.keep(_small_star(_large_star(now)), "stars")
        # a round without change leaves the same set of edges
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(now)
        now = after
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
