"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import looked_up, stored


def _point_up(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a vertex is linked to the smallest of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("_least"))
    return looked_up(both, least, "a").where("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))


def _point_down(links: DataFrame) -> DataFrame:
    """Each smaller neighbour of a vertex, and the vertex, is linked to the smallest of them."""
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = ordered.groupBy("a").agg(F.min("b").alias("_least"))
    moved = looked_up(ordered, least, "a").where("b != _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return moved.unionByName(least.select("a", F.col("_least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """vertex and root (the smallest vertex reachable) of every vertex with a link; ``links`` has columns a and b.

    Works on link rows only: minima are pre-aggregated, and the links of a
    vertex with very many of them are joined where they lie, never gathered.
    Rounds grow with the logarithm of the longest path.
    """
    current = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        current = stored(_point_down(stored(_point_up(current))))
        several = current.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
        chained = current.select(F.col("b").alias("a")).distinct().join(current.select("a"), "a", "left_semi")
        if several.unionByName(chained).isEmpty():  # only stars are left
            break
    return current.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
