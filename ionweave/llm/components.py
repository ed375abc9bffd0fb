"""Connected components of a table of links, by alternating stars.

Each round replaces links by links to smaller nodes: first every larger neighbour of a node is
linked to the node's smallest neighbour, then every smaller one.  Links end up as one star per component.
A round is two aggregations and two joins over links; nothing but a checksum gets to the driver, and each
round is stored, so that lineage stays short.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, stage: Callable[[DataFrame], DataFrame], rounds: int = 100) -> DataFrame:
    """``node`` and ``root``, its component's smallest node, for all nodes with links ``a``, ``b``.  Runs at once."""
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    before = None
    for _ in range(rounds):
        edges = stage(_small_star(_large_star(edges)))
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
