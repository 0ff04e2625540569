"""Connected components of links, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import written


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m) with the least of u's neighbours; the least is summed before the shuffle, hot nodes split in the join."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    starred = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    return starred.filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _with_least(down).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = down.groupBy("u").agg(F.min("v").alias("v"))
    return starred.union(own).filter("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node hangs below another and above a third, nor below two."""
    below = edges.groupBy("u").agg(F.count("*").alias("n"))
    chained = edges.select(F.col("v").alias("u")).join(below, "u", "left_semi")
    return below.filter("n > 1").unionByName(chained.select("u", F.lit(2).cast("long").alias("n"))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b); the root is the least node of its component.

    Links turn into stars around least nodes in a number of rounds that grows with the logarithm of their number; each
    round is a table in the shared folder, and only whether it holds nothing but stars reaches the driver.
    """
    down = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = written(_small_star(down), "links")
    while not _are_stars(edges):
        edges = written(_small_star(_large_star(edges)), "stars")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v"), F.col("v")).distinct())
