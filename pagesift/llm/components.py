"""Connected components over an edge table by alternating large-star and small-star rounds.

Each round is two hash aggregates and two joins whose one side has a single row per node, so a
node with very many neighbours is pre-aggregated and its join partition split, never gathered.
The edges and the nodes' minima are staged in the shared folder, which cuts the lineage and leaves each join
a shuffle of its own to split; nothing reaches the driver but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
    return (both.join(low, "u").filter("v > u AND v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
            .distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = staged(down.groupBy("u").agg(F.min("v").alias("m")), "low")
    moved = down.join(low, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``edges(a, b)`` with integer ids -> ``(node, component)``, component the smallest id
    reachable; only nodes that have an edge to another node. Raises if ``max_rounds`` rounds
    don't settle it."""
    cur = staged(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        cur = staged(_small_star(staged(_large_star(cur), "edges")), "edges")
        state = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            low = cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(low)
        seen = state
    raise RuntimeError("components did not settle")
