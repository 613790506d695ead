"""Connected components by alternating large-star and small-star, with the rows of hubs dealt out.

Both steps hang the neighbours of a node under the smallest node it sees, which is a join of the
edges with one row per node. All edges of a node would meet in the task of its key; so nodes
with more than a 4096th of all edges, of which there can be no more than 8192, are told apart by
a broadcast of that proven size, and their edges are dealt over SALTS keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from salesloom.llm.common import stage, unstage

SALTS = 64
SHARE = 4096  # a node is a hub with more than this share of all edges


def _written(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The edges as a table, their number and a sum of their hashes."""
    seen = Observation()
    table = stage(edges.observe(
        seen, F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"),
    ), name)
    return table, (seen.get["n"], seen.get["sum"])


def _hung(edges: DataFrame, n_edges: int) -> DataFrame:
    """(v, m): every edge's end v beside the least node m that its other end u sees, u included."""
    lowest = edges.groupBy("u").agg(
        F.min("v").alias("least"), F.count(F.lit(1)).alias("degree")
    ).select("u", F.least("u", "least").alias("m"), (F.col("degree") > n_edges // SHARE + 64).alias("hub"))
    hubs = F.broadcast(lowest.where("hub").select(F.col("u").alias("hub_node")))
    salt = F.when(F.col("hub_node").isNotNull(), F.pmod(F.xxhash64("v"), F.lit(SALTS))).otherwise(0)
    dealt = edges.join(hubs, F.col("u") == F.col("hub_node"), "left").select(
        "u", "v", salt.cast("int").alias("salt")
    )
    copies = F.when(F.col("hub"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(
        lowest.select("u", "m", F.explode(copies).alias("salt")), ["u", "salt"]
    ).select("u", "v", "m")


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v); root is the smallest node.

    Alternates both stars until no edge changes. Rounds grow with the logarithm of the longest
    chain; edges never multiply, and each round's are written to the shared folder, the ones
    before deleted. Loops, repeated edges and an empty table are allowed; an edge with a NULL end is
    none. Two numbers per round reach the driver.
    """
    current, state = _written(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct(), name)
    while state[0]:
        # Large star: larger neighbours go under the least node in sight.
        both = current.union(current.select("v", "u"))
        down = _hung(both, 2 * state[0]).where("v > u and v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        # Small star: every edge points down now; a node and its smaller neighbours go under the least.
        hung = _hung(down, state[0]).select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.*").where("u <> v").distinct()
        after, new_state = _written(hung, name)
        unstage(current)
        done, current, state = new_state == state, after, new_state
        if done:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()
