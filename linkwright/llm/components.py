"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import written


def _stars(edges: DataFrame, name: str) -> DataFrame:
    """One large-star and one small-star step over edges (a, b), a > b. Both hang neighbours onto the least
    one by a grouped minimum and a join, so that no node's neighbours ever meet in one task;
    the minima are written first, for Spark splits only joins of plain scans when a node is hot."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{name}-large")
    large = written(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), f"{name}-hung")
    least = written(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-small")
    small = large.join(least, "a")
    small = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return small.distinct()


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """node, root (the least node of its component) of every node with an edge; edges (a, b) of longs in any
    order. Each round is written to the shared folder, so that lineage stays short."""
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = written(edges, name), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 30))).first()
        if state == before or not state[0]:
            break
        before, edges = state, written(_stars(edges, name), name)
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
