"""Connected components of a link table, by alternating large and small stars.

Each round hangs the larger neighbours of every node on its smallest one, then does
the same with the smaller neighbours; the longest path shrinks geometrically, so the
rounds grow with the logarithm of the size.  A round reads and writes a table in the
shared folder; nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node
    of its component.  Nodes without a link to another node do not appear."""
    edges = land(edges.select("a", "b").where("a != b").distinct(), "links")
    seen = None
    while True:
        edges = land(_small_star(_large_star(edges)), "stars")
        mark = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen or not mark[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = mark
