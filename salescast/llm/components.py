"""Connected components of a graph given as links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.text import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node reachable.

    ``links`` has columns ``a`` and ``b``. Large-star and small-star steps turn
    each component into a star around its smallest node. Every step is joins and
    aggregates over links; a step is checkpointed, and only a count and a checksum
    reach the driver.
    """
    up, down = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    links = cut(links.where("a <> b").select(up, down).distinct())
    seen = _checksum(links)
    while seen[0]:
        both = links.union(links.select("b", "a"))
        lowest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        lowest = lowest.select("node", F.least("node", "m").alias("m"))
        large = both.join(lowest, both["a"] == lowest["node"]).where("b > a AND b <> m")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        small = large.join(lowest, large["a"] == lowest["node"]).where("b <> m")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = cut(small.union(lowest.select(F.col("node").alias("a"), F.col("m").alias("b"))).distinct())
        now = _checksum(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select("b", "b").distinct())


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
