"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notequarry.session import materialise


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are tied to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are tied to the smallest of them."""
    low = _lowest(edges)
    tied = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return tied.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the (u, v) rows; root is the component's smallest node.

    Edges are undirected longs; u = v and nulls are ignored. Every step is joins and
    minima, so a node with very many neighbours is never gathered in one group, and every
    round is written to the shared folder. Stops when a round changes nothing.
    """
    ends = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = materialise(ends.distinct(), "edges")
    before = None
    for _ in range(rounds):
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = seen
        now = materialise(_small_star(_large_star(now)), "edges")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
