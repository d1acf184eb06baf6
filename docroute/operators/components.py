"""Connected components of a table of links, in rounds of aggregates and equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.session import checkpointed


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) but the smallest of its component, which is the root.

    Large and small stars in turn: first each node hands its larger neighbours to the smallest node it knows, then its
    smaller ones. A hub's links are aggregated before the shuffle and never gathered; rounds grow with the logarithm of
    the longest path.
    """
    stars = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())
        if now == before or not now[0]:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least)
        stars = checkpointed(small.distinct())
