"""Connected components of a large graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import stage


def _fingerprint_of(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return both.join(least, both.u == least.k).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to its smallest neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    moved = edges.join(least, edges.u == least.k).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """``(node, root)`` for every node of an edge ``(u, v)``; root is the smallest node reachable.

    ``u`` and ``v`` are comparable values; loops and null ends are left out,
    repeated and reversed edges count once.  Each round halves the stars'
    height, and its result is a written table.  Raises if ``most_rounds`` do
    not suffice rather than returning unfinished components.
    """
    now = stage(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _fingerprint_of(now)
    for _ in range(most_rounds if before["n"] else 0):
        now = stage(_small_star(_large_star(now)), "edges")
        after = _fingerprint_of(now)
        if after == before:
            break
        before = after
    else:
        if before["n"]:
            raise RuntimeError(f"components not settled after {most_rounds} rounds")
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
