"""Connected components of a graph of numbered nodes, as rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.scratch import written


def _digest(edges: DataFrame) -> tuple:
    """Equal for equal edge sets (64-bit row hashes added up)."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``a`` and the smallest node ``b`` of its component, for every node ``a`` but that one.

    ``edges`` has long columns ``a`` and ``b``.  Each round hangs every neighbour on the
    smallest one it can see, first the larger, then the smaller ones, until nothing changes:
    a number of rounds that grows with the logarithm of the longest path, not with its length.
    Minima are added up before the shuffle and joins split skewed keys, so a node with very
    many neighbours is no single task.  Every round is a written table.
    """
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _digest(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = edges.select(F.col("a").alias("v"), F.col("b").alias("a")).join(lowest, "a").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = written(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    return edges
