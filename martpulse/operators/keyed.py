"""First, latest and unseen rows per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list[str], choose) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    # An aggregate, not a window: each task keeps one row per key before the shuffle, so a key that
    # holds a third of the table sends one row per task.
    picked = df.groupBy(*keys).agg(choose(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def first_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` of each key."""
    return _pick(df, keys, order, F.min_by)


def latest_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` of each key."""
    return _pick(df, keys, order, F.max_by)


def unseen(batch: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key does not occur in ``seen``, which may hold a key many times."""
    return batch.join(seen.select(*keys).distinct(), keys, "left_anti")
