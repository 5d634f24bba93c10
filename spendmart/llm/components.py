"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is one grouped minimum and one join, so that a node with very many neighbours is
combined before the shuffle and split in the join. Every step is written to the shared folder, and
the one before is removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmart.staging import Stages


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours (the larger ones for a large star, else the others) to the
    smallest node at hand.
    """
    if large:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where(F.col("u") != F.col("v")).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every edge joins a node of no other edge to its component's smallest node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("above")).unionAll(edges.select("v", F.lit(0)))
    nodes = ends.groupBy("node").agg(F.sum("above").alias("above"), F.count("*").alias("n"))
    return nodes.where((F.col("above") > 1) | ((F.col("above") > 0) & (F.col("n") > F.col("above")))).isEmpty()


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """``node, component`` for every node of an edge between different nodes; the component is its
    smallest node. Self-links, repeated and reversed edges change nothing; nulls link nothing.
    """
    now = (
        edges.where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v)))
        .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .distinct()
    )
    stages = Stages(edges.sparkSession, "edges")
    now = stages.next(now)
    while not _all_stars(now):
        now = stages.next(_star(stages.next(_star(now, True)), False))
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
