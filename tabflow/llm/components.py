"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the node's smallest neighbour
    (or the node itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), "star")
    # Read from a table, the smallest neighbours are a plain join side, so a hot node's edges can be split.
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, link to the smallest."""
    least = materialize(edges.groupBy("u").agg(F.min("v").alias("least")), "star")
    moved = edges.join(least, "u").where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node but the smallest ones
    themselves. ``edges``: u, v in any direction; loops and repeats are fine.
    Each round is a written table, so a lost executor costs one round at most."""
    undirected = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = materialize(undirected.distinct(), "edges")
    state = _state(now)
    while True:
        now = materialize(_small_star(materialize(_large_star(now), "edges")), "edges")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
