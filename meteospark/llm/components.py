"""Connected components of a graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteospark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node with an edge; edges: a, b (long).

    Each round hangs the larger neighbours of a node, then all its smaller ones, on the smallest, until
    every component is a star. Rounds are written to the shared folder; only two sums a round reach the
    driver. Loops and repeated edges count for nothing, edges with a null are dropped.
    """
    found = edges.where(F.col("a") != F.col("b"))
    now = stored(
        found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.union(least).distinct(), "edges")
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("b", "b"))
