"""Connected components of an edge table, all of it in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from salesloom.llm.common import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))


def _staged(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The edges as a table; their number and a sum of their hashes, taken while they are
    written: equal if no edge changed."""
    seen = Observation()
    table = stage(edges.observe(
        seen, F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"),
    ), name)
    return table, (seen.get["n"], seen.get["sum"])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v); root is the smallest node.

    Alternates two steps until no edge changes. Large star: the larger neighbours of a node
    are hung under the smallest node it sees. Small star: so are the node itself and its
    smaller neighbours. The number of rounds grows with the logarithm of the longest chain,
    edges never multiply, and each round's edges are written to the shared folder, so lineage
    stays short. Two numbers per round reach the driver.
    """
    current, state = _staged(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct(), name)
    while state[0]:
        large = _both_ways(current)
        lowest = large.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u"), F.least("u", "m").alias("m")
        )
        hung = large.join(lowest, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).where(F.col("u") != F.col("v")).distinct()
        # Every row now points from a node to a smaller one.
        down = hung.groupBy("u").agg(F.min("v").alias("m"))
        small = hung.join(down, "u").where(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).union(down.select("u", F.col("m").alias("v"))).distinct()
        before = state
        current, state = _staged(small, name)
        if state == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()
