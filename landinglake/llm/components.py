"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landinglake.llm.tables import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), "a").alias("least"))
    return (both.join(least, "a").filter("b > a and b > least")
            .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return (moved.unionByName(least.select("a", F.col("least").alias("b")))
            .filter("a > b").distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b): for every node of ``edges`` (a, b) but the roots, the least node of its component.

    Loops and repeated edges are fine. Each round is written to the shared folder; rounds grow
    with the logarithm of the longest path.
    """
    def state(frame):
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())

    current = stored(edges.select("a", "b").filter("a != b").distinct(), "edges")
    before = None
    while (now := state(current)) != before:
        before = now
        current = stored(_small_star(_large_star(current)), "edges")
    return current
