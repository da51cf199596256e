"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intactly.llm.common import staged


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges a > b; every edge of the result is a > b again."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (both.where("v > u").join(least, "u").where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
             .distinct())
    smallest = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(smallest, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(smallest.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) of every node of ``edges`` (longs a and b; loops are ignored).

    Each round is written to the shared folder, so lineage stays short. The rounds end when the edges are stars, after
    a number that grows with the logarithm of the longest path.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "edges")
    state = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = state(now)
    while before[0]:
        now = staged(_stars(now), "edges")
        after = state(now)
        if after == before:
            break
        before = after
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        roots.select(F.col("b").alias("node"), F.col("b").alias("label")))
