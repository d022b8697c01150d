"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyquarry.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: what is greater than a node moves to the least of its neighbourhood. Small star: the node and what is less."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    joined = near.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(node, root) of every node with an edge; root is the least node reachable. edges: a, b of one orderable type.

    Each round is a table in the shared folder, so that the plan stays short; rounds grow with the logarithm of the longest path.
    """
    now = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = None
    for _ in range(most_rounds):
        now = saved(_star(_star(now, True), False), "edges")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
