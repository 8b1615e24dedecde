"""Connected components by alternating star contractions, on edge tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import stable


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low.hint("merge"), "u").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low.hint("merge"), "u").filter("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )
    return moved.unionByName(low.withColumnRenamed("m", "v")).distinct()


def components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of the links, component being its smallest node.

    Each round is a few shuffles of the links that are left, written to the
    checkpoint folder; the number of rounds grows with the logarithm of the
    longest path.  Self links and repeated links do no harm; no links, no rows.
    """
    edges = stable(
        pairs.filter(F.col(a) != F.col(b)).select(
            F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
        ).distinct()
    )
    state = _state(edges)
    while True:
        edges = stable(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
