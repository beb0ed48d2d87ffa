"""Connected components by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quoteflow.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the edges (``a``, ``b``); the root is the smallest node.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest node
    around it; the rounds grow with the logarithm of the longest path. Minima are taken before any
    shuffle, and a hub's edges are joined, not collected, so a huge component stays spread out. Every
    round is written to the shared folder.
    """
    now = _stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b"))
    seen = _mark(now)
    while seen[0]:
        now = _stored(_small_star(_large_star(now)))
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    # Settled edges are stars around their roots.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _stored(edges: DataFrame) -> DataFrame:
    return stored(edges.distinct(), "edges")


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum: alike only when a round changed nothing."""
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Stored first, so that the join has partitions of its own and Spark can split those of a hub.
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))
