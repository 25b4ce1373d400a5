"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _least(neighbours: DataFrame) -> DataFrame:
    """Each node with the smallest id among itself and its neighbours. Tasks combine before the shuffle."""
    return neighbours.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    star = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return star.where("u != v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    star = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return star.unionAll(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """One row (id, component) per linked node that isn't the smallest of its component.

    ``links``: two columns of ids, in either direction, repeated or not; a node's link
    to itself and links with a null are ignored. ``component`` is the smallest id that
    links reach. A node without a row is its own component. Every round is cut from
    its lineage; the number of rounds grows with the logarithm of the longest path.
    An empty table gives an empty result.
    """
    now = links.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u != v").distinct()
    now = cut(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        now = cut(_small_star(_large_star(now)))
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == state:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        state = seen
