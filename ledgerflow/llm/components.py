"""Connected components of an edge table, as joins and aggregates over rows of (u, v)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge, the least node of its component as label. Edges
    are (u, v); loops and repeats do no harm. Rounds alternate until the stars are final: the number
    of rounds grows with the logarithm of the longest path. A node with very many neighbours is one
    key of a join whose large side can be split."""
    edges = stored(edges.select("u", "v").where("u <> v").distinct(), "edges")
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        # Sums over all edges: the same rows give the same numbers.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        before = now
