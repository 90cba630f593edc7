"""Connected components of a graph of links, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.functions.storage import cut_lineage


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the least neighbour of a, or a itself if that is less.

    The least ones are folded before the shuffle and joined back, so a node with very many
    neighbours is split like any skewed key of a join.
    """
    least = edges.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("least"))
    return edges.join(least, F.col("a") == F.col("_a")).select("a", "b", F.least("a", "least").alias("least"))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of the undirected edges (a, b).

    Rounds of large and small stars: each node links its larger neighbours, then its smaller ones, to
    the least it knows, until every component is a star; some log(n) rounds, each stored. Loops and
    repeated edges are allowed; null ends are ignored.
    """
    edges = cut_lineage(edges.select("a", "b").where("a <> b").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        down = large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        marked = _with_least(down)
        small = marked.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            marked.select("a", F.col("least").alias("b")))
        edges = cut_lineage(small.where("a <> b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
