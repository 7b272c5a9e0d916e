"""Connected components of a table of links, by alternating stars.

Each round links every node and its greater neighbours to the least neighbour, then
every node's lesser neighbours. Stars come out: each node beside the least node of
its component. Rounds are few (about the logarithm of the longest path), each is two
group minima, combined before the shuffle, and joins whose hot keys Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, stored


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    both = _both(links)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) of the nodes in ``links`` (``a``, ``b``).

    Nodes are numbers. Repeated links, links of a node to itself and either order are
    the same as one; a row with a null is no link. Nodes without a link to another do
    not come out. No links give no rows.
    """
    links = stored(links.where("a <> b").select("a", "b").distinct(), "links")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    before = state(links)
    while before[0]:
        last, links = links, stored(_small_star(_large_star(links).distinct()).distinct(), "links")
        forget(last)
        after = state(links)
        if after == before:
            break
        before = after
    found = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return found.unionAll(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
