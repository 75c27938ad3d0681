"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.native import table

MAX_ROUNDS = 50


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node sends itself and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    down = edges.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return down.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``(a, b)`` links that is not its own least one.

    Stars are made in turn over larger and over smaller neighbours until nothing moves;
    the rounds grow with the logarithm of the longest chain. Each round is a table in the
    shared folder. A hub's links are aggregated before the shuffle, and adaptive
    execution splits its joins.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    edges = table(edges.select(a.alias("a"), b.alias("b")).filter("a <> b").distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        edges = table(_small_star(_large_star(edges)), "stars")
        # the links that are left, as a count and an order-free sum
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
    raise RuntimeError(f"links did not settle in {MAX_ROUNDS} rounds")
