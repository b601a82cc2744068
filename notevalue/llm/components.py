"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is two aggregations and two joins; minima and edges are written between them. A node that
touches a third of all edges is one key: minima combine before the shuffle, and the joins are plain
equi-joins that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notevalue.session import cut


def _star(near: DataFrame, larger_only: bool) -> DataFrame:
    """Hang the neighbours `v` of every `u` on the least node among them and `u`."""
    # Written first: only a join of plain tables is one that adaptive execution splits at a hot node.
    least = cut(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    hung = near.join(least, "u")
    if larger_only:
        return hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.filter("m < u").select("u", F.col("m").alias("v"))
    return hung.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)


def _state(edges: DataFrame) -> tuple:
    """Equal for equal edge tables."""
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def components(edges: DataFrame) -> DataFrame:
    """`node, root` for every node of the edges (u, v) that is not its component's least node.

    Edges may repeat, be given in either direction or join a node to itself; none gives no rows.
    """
    edges = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while (state := _state(edges)) != before:
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = cut(_star(both, larger_only=True).filter("u <> v").distinct())
        edges = cut(_star(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), larger_only=False).filter("u <> v").distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
