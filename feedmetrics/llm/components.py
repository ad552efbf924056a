"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import land


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """``row, label`` for every end of the links ``a, b``: the smallest number its component holds.

    Rounds repeat until a round changes nothing; each is cut by a table in the shared folder. Sums
    and joins only: no row ever holds a node's neighbours.
    """
    edges = land(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        stars = land(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        if stars.join(edges, ["u", "v"], "left_anti").isEmpty() and edges.join(stars, ["u", "v"], "left_anti").isEmpty():
            roots = stars.select("v").distinct()
            return stars.select(F.col("u").alias("row"), F.col("v").alias("label")).union(roots.select("v", "v"))
        edges = stars
