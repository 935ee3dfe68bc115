"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: root is the smallest node
    reachable. Self links only keep their node. Each round is written to the shared
    folder, so lineage stays short; rounds grow with the logarithm of the longest chain.
    """
    edges = stored(edges.toDF("a", "b").distinct(), "links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    stars, mark = edges.where("a <> b"), None
    while True:
        stars = stored(_small_star(_large_star(stars)), "stars")
        row = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == mark or not row[0]:
            break
        mark = tuple(row)
    return nodes.join(stars.toDF("node", "root"), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"))
