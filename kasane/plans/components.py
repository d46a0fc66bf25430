"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasane.plans.staging import release, stage


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(both: DataFrame) -> DataFrame:
    """The smallest neighbour of each node, itself included."""
    return both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(both: DataFrame, least: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (itself included)."""
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the node's smallest neighbour."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its smallest node.

    Each round is written to the shared folder, so a lost executor costs at most one round, and the round before is
    deleted. Rounds grow with the logarithm of a component's size; nothing is gathered on the driver but a count and a
    checksum. The smallest neighbours are staged, so the join that moves the edges of a node with very many neighbours
    has two plain shuffled sides, which adaptive execution splits.
    An empty edge table gives an empty result; self-links and null ends are ignored.
    """
    edges = stage(edges.where("u is not null and v is not null and u <> v").select("u", "v").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = _both(edges)
        least = stage(_least(both), "least")
        before, edges = edges, stage(_small_star(_large_star(both, least)), "edges")
        release(before, least)
        after = _mark(edges)
        if after == mark:
            break
        mark = after
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
