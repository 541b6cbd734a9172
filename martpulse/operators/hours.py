"""Series of 24 hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martpulse.functions.times import hour_key

HOURS = 24
OTHER = "other"


def hour_spine(spark: SparkSession) -> DataFrame:
    return spark.range(HOURS).select(hour_key(F.col("id")).alias("hour"))


def fill_hours(series: DataFrame, values: list[str]) -> DataFrame:
    """All 24 hours, with 0 where ``series`` (one row per hour) has none.

    Values under anything else than an hour of the day follow in one row of their own, ``other``, so that the rows
    still add up to the day; it is left out when there are none.
    """
    # Broadcast bound: at most one row per hour key of the spine is of use, 24 in all.
    hours = [f"{h:02d}" for h in range(HOURS)]
    known = series.where(F.col("hour").isin(hours))
    joined = hour_spine(series.sparkSession).join(F.broadcast(known), "hour", "left")
    odd = series.where(~F.coalesce(F.col("hour").isin(hours), F.lit(False))).agg(
        F.count("*").alias("n"), *[F.sum(v).alias(v) for v in values]
    )
    rows = joined.unionByName(odd.where("n > 0").select(F.lit(OTHER).alias("hour"), *values))
    return rows.select("hour", *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values])


def hour_map(series: DataFrame, value: str) -> DataFrame:
    """The series (one row per hour, so 24 at most) as one row with a map from hour to value."""
    pairs = F.array_sort(F.collect_list(F.struct("hour", value)))
    return series.agg(F.map_from_entries(pairs).alias("hours"))
