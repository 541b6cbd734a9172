"""Joins that hold when one key has a large share of the rows.

Inner and left joins of tables are left to Spark: sizes decide between broadcast and shuffle, and a hot key's
shuffle partition is split at run time. Two cases that run-time splitting does not cover are written out here:
full outer joins, and joins of two streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def full_outer(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """``many`` full outer join ``one`` on ``key``, where ``many`` may be skewed.

    A left join, whose hot partitions can be split, plus the rows of ``one`` whose key does not occur in
    ``many``; for those the keys of ``many`` are made distinct before the shuffle.
    """
    left = many.join(one, key, "left")
    lonely = one.join(many.select(key).distinct(), key, "left_anti")
    return left.unionByName(lonely, allowMissingColumns=True)


def salted(df: DataFrame, row_id: Column, salts: int) -> DataFrame:
    """Spread the rows of each key over ``salts`` groups, by a value of the row itself (stable on retry)."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int"))


def replicated(df: DataFrame, salts: int) -> DataFrame:
    """One copy of each row per salt, to meet a salted side."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

