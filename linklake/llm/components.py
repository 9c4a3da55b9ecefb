"""Connected components by alternating star contraction, entirely in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linklake.llm.tables import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(neighbours: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (larger ones, or all smaller ones) are hung on its smallest."""
    least = neighbours.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    rows = neighbours.join(least, "a")
    if large:
        moved = rows.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = rows.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b")))
    return moved.where("a > b").distinct()


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges(a, b)``: label is the smallest id of its component.

    Rounds are logarithmic in the longest path; each is two joins of unique against
    repeated keys, so a hub's neighbours are split by adaptive execution.
    """
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = current.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if tuple(mark) == seen or mark[0] == 0:
            break
        seen = tuple(mark)
        larger = _star(_both_ways(current), large=True)
        current = stored(_star(larger.where("b < a"), large=False), "edges")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
