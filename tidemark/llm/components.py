"""Connected components of a graph given as edges, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One round over edges (u, v) with u > v, by joins with the smallest neighbour of each node.

    large: every larger neighbour of a node hangs on the node's smallest neighbour (itself included).
    small: every smaller neighbour and the node hang on its smallest neighbour.
    The smallest neighbour is an aggregate, so the edges of a node never meet in one task.
    """
    if larger:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if larger:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select("v", "m").union(joined.select("u", "m").distinct())
        moved = moved.toDF("u", "v")
    return moved.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (a, b) can reach.

    The number of rounds grows with the logarithm of the size of a component. Each round is written to the
    shared folder, so a lost executor costs one round at most, and only two numbers come to the driver.
    """
    current = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(
        F.col("u") != F.col("v")).distinct()
    current = kept(current, "edges")
    last = None
    while True:
        current = kept(_star(_star(current, True), False), "edges")
        # A sum of hashes of the edge set: it stays when a round changes nothing.
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == last:
            break
        last = tuple(mark)
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
