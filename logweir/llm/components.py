"""Connected components by alternating stars; every round is a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.tables import remove, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least of its neighbours and itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(a, root): for each node of edges (a, b) other than a root, the least node it reaches."""
    stars = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), f"{folder}/stars-0"
    )
    turn = 0
    while not _are_stars(stars):
        turn += 1
        stars = written(_small_star(_large_star(stars)), f"{folder}/stars-{turn}")
        remove(edges.sparkSession, folder, f"stars-{turn - 1}")
    return stars.select("a", F.col("b").alias("root"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge to a smaller node, or only edges from larger ones."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("root")).union(
        edges.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("root"))
    )
    sums = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return sums.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("root") > 0)))).first()[0] == 0
