"""Connected components of an edge table, by alternating star contractions.

Each round joins every node to the smallest node it knows. Nothing is gathered but one minimum
per node; each round is written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for each node of ``edges (a, b)``.

    Self loops, repeated and reversed edges are allowed; rows with a null end are ignored. An
    empty table gives an empty table.
    """
    pairs = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = stored(pairs.distinct(), "edges")
    state = _state(current)
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            break
        current = stored(_small_star(_large_star(current)), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is joined to the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are joined to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()
