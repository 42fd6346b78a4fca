"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflow.llm.common import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One step over edges (a, b) with a < b. Every step keeps the components and lowers the ends of edges.

    The smallest neighbour is a map-side combine, and stored: both sides of the join back to the edges then come straight from an exchange,
    which is what adaptive execution can split, so a node with very many neighbours is no hot task.
    """
    if small:
        least = stored(edges.groupBy("b").agg(F.min("a").alias("least")), "least")
        met = edges.join(least, "b")
        moved = met.select(F.col("least").alias("a"), F.col("a").alias("b")).unionByName(met.select(F.col("least").alias("a"), "b"))
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), "least")
        met = both.where("v > u").join(least, "u")
        moved = met.select(F.col("least").alias("a"), F.col("v").alias("b"))
    return moved.where("a < b").distinct()


def components(edges: DataFrame, name: str = "component") -> DataFrame:
    """(node, component): the smallest node that edges (a, b) of bigints reach. Nodes without an edge to another are left out."""
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges = stored(edges, "edges")
    seal = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = seal(edges)
    while before[0]:
        edges = stored(_star(stored(_star(edges, False), "edges"), True), "edges")
        after = seal(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("b").alias("node"), F.col("a").alias(name))
    return stars.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias(name)).distinct())
