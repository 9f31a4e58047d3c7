"""Connected components of an edge table by alternating large-star and
small-star steps. Edges point from the larger node to the smaller one, so a
step is a minimum per node and a join: a node with very many neighbours is
reduced on the map side and split by the skew join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its least neighbour (or stay, if it is the least itself)."""
    least = _least(edges).withColumnRenamed("u", "n")
    return (edges.join(least, edges.v == least.n, "left")
            .select("u", F.coalesce("m", "v").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of these."""
    least = _least(edges)
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or smaller and larger ones."""
    ends = (edges.select(F.col("u").alias("n"), F.lit(1).alias("down"), F.lit(0).alias("up"))
            .union(edges.select("v", F.lit(0), F.lit(1))))
    node = ends.groupBy("n").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not node.agg(F.max(F.expr("down > 1 or (down = 1 and up = 1)"))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node that has an edge, but the least of its component, with
    that least node. ``edges`` has long columns u, v; repeated edges and loops
    are allowed. The steps end when the edges are a forest of stars."""
    edges = materialize(edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _is_star_forest(edges):
        edges = materialize(_small_star(_large_star(edges)), "edges")
    return edges
