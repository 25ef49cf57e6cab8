"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import checkpointed


def _large_stars(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest one."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    ).distinct()


def _small_stars(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and the node, are tied to the smallest."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").selectExpr("b as a", "least as b")
    return moved.union(least.selectExpr("a", "least as b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``, except those
    that are the smallest of their component; the component is that smallest.

    Nodes are longs. Nulls and loops count for nothing; directions and
    repetitions don't matter. Minima are taken per task before the shuffle and
    joined back as one row per node, so that a node with very many neighbours
    is a skewed join side, which adaptive execution splits. Each round is
    stored in the checkpoint folder; only counts come to the driver.
    """
    now = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    signature = lambda df: df.agg(
        F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
    ).first()
    before = signature(now)
    while before[0]:
        now = checkpointed(_small_stars(_large_stars(now)))
        after = signature(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
