"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.plans.session import Scratch


def connected(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(node, root)``: every node of an edge with the smallest node of its component.

    Each round points the larger neighbours of a node at its smallest one (large star), then the smaller ones (small
    star), until nothing changes; rounds grow with the logarithm of the longest path. A node's smallest neighbour is a
    pre-aggregated minimum, and the join that hands it out is one that Spark can split at a hub. Rounds are written to
    ``scratch``, so a lost executor costs one round. Loops and repeated edges are allowed; null ends are dropped.
    """
    now = scratch.keep(
        edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen:
            break
        seen = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = now.groupBy("a").agg(F.min("b").alias("low"))  # in now, b < a: the least neighbour below a
        large = both.where("b > a").join(low, "a", "left").select(F.col("b").alias("a"), F.coalesce("low", "a").alias("b"))
        large = scratch.keep(large.distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("e"))
        now = scratch.keep(small.select("e.a", "e.b").where("a <> b").distinct(), "small")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
