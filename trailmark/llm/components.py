"""Connected components over an edge table, with no node or edge on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MAX_ROUNDS = 60


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them (a > b in all edges)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``a, b`` (long, any order) -> node, component (the smallest node reachable).

    Alternates large-star and small-star until the edges stand still; every round is
    a table in the shared checkpoint folder.  A hub's minimum is pre-aggregated, and its
    join is one that Spark may split when skewed.  Only nodes with an edge are returned.
    """
    current = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            # at rest every edge leads straight to its component's smallest node
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
        before = now
        current = stored(_small_star(_large_star(current).distinct()).distinct(), "edges")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
