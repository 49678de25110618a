"""Connected components of an edge table, with DataFrame operations only.

Rounds of two steps (neighbours above a node join its least neighbour; then a node and its
lower neighbours join the least of them) shrink every component to a star around its least
node. Least neighbours come from a partial aggregation and a join, so a node with very many
neighbours is never gathered in one task; each round is written to the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.session import materialised, release


def _settled(edges: DataFrame) -> bool:
    """Whether distinct edges (u, v), v < u, are stars: every u has one v and is nobody's v."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def _toward_least(edges: DataFrame) -> DataFrame:
    """(u, v) with v < u -> every u and its neighbours v linked to the least v of that u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has an edge to another one; component is the
    least node that can be reached. Nulls, loops and repeated edges change nothing; no edges
    give no rows."""
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    edges = materialised(edges)
    while not _settled(edges):
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialised(_toward_least(large))
        release(edges.sparkSession)  # the rounds before
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v"), F.col("v")).distinct())
