"""Connected components by alternating star contractions.

Each round links every node's larger neighbours, then its smaller ones, to its smallest neighbour. Every round is written as a
stage table, so lost executors cost one round at most, and nothing but two totals comes to the driver. The table of
smallest neighbours is staged as well: both sides of the join are then plain shuffles, which Spark can split where a
component's centre has very many neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlaslex.staging import stage


def _smallest(pairs: DataFrame) -> DataFrame:
    found = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return stage(found.select("u", F.least("u", "m").alias("m")), "smallest")


def _large_star(edges: DataFrame) -> DataFrame:
    """(v, smallest of u and its neighbours) for every neighbour v > u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = both.join(_smallest(both), "u").where("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours, linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = down.join(_smallest(down), "u")
    moved = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(linked.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("v", "u"))).first())


def connected_components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node that is not a root itself.

    ``edges`` has two long columns ``u`` and ``v``; loops and repeats are allowed, nulls are left out. Raises after
    ``rounds`` rounds: contraction needs about the logarithm of the largest component's size.
    """
    edges = stage(edges.where("u <> v").select("u", "v").distinct(), "edges")
    state = _state(edges)
    for _ in range(rounds if state[0] else 0):
        edges = stage(_small_star(stage(_large_star(edges), "large-star")), "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        if state[0]:
            raise RuntimeError(f"components are not settled after {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
