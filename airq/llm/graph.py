"""Connected components of an edge table, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Every round hangs the larger neighbours of each node, then its smaller ones, on the smallest of them,
    until the edges form stars. Rounds grow with the logarithm of the longest path; each is cut off with a
    checkpoint. A node with many edges is aggregated before the shuffle and its join can be split. Null and
    equal ends are ignored.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        now = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = now.unionByName(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        least = now.groupBy("a").agg(F.min("b").alias("m"))
        now = now.join(least, "a")
        now = (
            now.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(now.select("a", F.col("m").alias("b")))
            .distinct()
        )
        now = materialise(now)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    inner = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return inner.unionByName(roots)
