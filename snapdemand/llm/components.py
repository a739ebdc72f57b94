"""Connected components of a graph given as pairs of longs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that has an edge in ``edges(a, b)``; root is the smallest node of its component.

    Alternating stars: each step hangs the neighbours of a node below the smallest of them, first the larger ones, then
    the smaller ones. Steps grow with the logarithm of the size, not with the length of a chain. Minima are taken
    by grouping with partial results, and a node with very many neighbours is on the many side of its join only.
    Empty input gives no rows; loops and repeated edges change nothing.
    """
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                      F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct())
        edges = written(small, "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root")))
