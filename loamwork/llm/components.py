"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loamwork.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    """Number of edges and the sum of their hashes: equal sets have equal signatures, others with a chance of 2**-64."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex reachable from each vertex that has an edge. ``edges`` has bigint columns a and b.

    Alternating large-star and small-star steps: every step hangs a vertex's neighbours under the smallest of them. A step
    is one aggregation and one join, its result is written before the next; the number of steps grows with the logarithm
    of the longest chain. A vertex of very high degree is a hot key of a join only, which adaptive execution splits.
    """
    current = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    if current.isEmpty():
        return current.select(F.col("a").alias("v"), F.col("b").alias("root"))
    signature = _signature(current)
    while True:
        # Large star: neighbours above a vertex go under the smallest of its neighbourhood.
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # Small star: neighbours below a vertex, and the vertex, go under the smallest of them.
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(down.select(F.col("m").alias("a"), "b"))
        following = stored(small.where("a <> b").distinct(), "edges")
        before, signature = signature, _signature(following)
        current = following
        if signature == before:
            break
    leaves = current.select(F.col("b").alias("v"), F.col("a").alias("root"))
    return leaves.unionByName(leaves.select(F.col("root").alias("v"), "root").distinct())
