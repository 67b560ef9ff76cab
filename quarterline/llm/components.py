"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import dealt, staged


def _stars_only(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is no smaller end: then the smaller ends are the components."""
    ends = edges.select("u", F.lit(1).alias("larger"), F.lit(0).alias("smaller")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("larger"), F.lit(1).alias("smaller")))
    both = ends.groupBy("u").agg(F.sum("larger").alias("larger"), F.max("smaller").alias("smaller"))
    return both.where("larger > 1 or (larger = 1 and smaller = 1)").isEmpty()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u > v). The minima are combined before their shuffle; a hub's edges can be split."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    pairs = both.join(dealt(both.groupBy("u").agg(F.min("v").alias("m")), "u"), "u")
    if large:
        out = pairs.where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    else:
        out = pairs.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
    return out.where("u <> v").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node of an edge; component: the smallest node reachable.

    Loops, repeated and reversed edges and edges with a null end are allowed; loops and nulls say nothing and are left
    out. The rounds grow with the logarithm of the nodes.
    """
    now = staged(edges.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "star-edges")
    while not _stars_only(now):
        now = staged(_star(staged(_star(now, large=True), "star-large"), large=False), "star-small")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
