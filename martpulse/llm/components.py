"""Connected components by large-star and small-star rounds over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martpulse.llm.store import settle


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Hangs every neighbour beyond (large) or up to (small) a node on the smallest node around it.

    The smallest neighbours are folded per task and stored, so that a node with very many links is split by the join.
    """
    if large:
        near = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = settle(near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "star")
    met = near.join(least.withColumnRenamed("a", "c"), F.col("a") == F.col("c"))
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _digest(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node reached; nodes without links are left out. Links are (a, b)."""
    pairs = settle(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, now = None, _digest(pairs)
    while now != before:
        pairs = settle(_star(settle(_star(pairs, True), "large"), False), "small")
        before, now = now, _digest(pairs)
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
