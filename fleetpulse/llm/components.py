"""Connected components of an edge table, by alternating large-star and
small-star steps.

Every step is a partial aggregation (the smallest neighbour of each vertex)
and a join back, so the edges of a vertex are never collected. A hub's edges do
stream through one join task, though: the smallest neighbours come from an
aggregate in the same stage, so AQE cannot split that partition (rows are two
keys). Steps are staged as files in the shared folder; the number of rounds
grows with the logarithm of the longest chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v), u > v. Large star: the larger neighbours of every vertex
    move to its smallest neighbour (or itself); small star: its smaller
    neighbours and itself do."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    moved = both.join(low, "u")
    if large:
        out = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root): every vertex of an edge (u, v) with the smallest vertex
    of its component. Vertices may be of any type with an order."""
    e = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
              "components")
    mark = _mark(e)
    while True:
        e = stage(_star(_star(e, True), False), "components")
        new = _mark(e)
        if new == mark:
            break
        mark = new
    return e.select(F.col("u").alias("vertex"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct())
