"""Counts and shares of search hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martpulse import constants as K
from martpulse.functions.numbers import is_old, is_young, percent, rest


def terms(hits: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Number of hits per value, largest first; hits without a value are not counted."""
    counts = (
        hits.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count("*").alias("doc_count"))
    )
    return counts.orderBy(F.desc("doc_count"), "key").limit(limit) if limit else counts


def total_columns() -> list[Column]:
    """Everything the shares need, as aggregates."""
    return [
        F.count("*").alias("total"),
        F.count_if(F.col("user_gender") == K.MALE).alias("male"),
        F.count_if(is_young(F.col("user_age"))).alias("young"),
        F.count_if(is_old(F.col("user_age"))).alias("old"),
    ]


def totals(hits: DataFrame) -> DataFrame:
    """One row with everything the shares need, from one pass over the hits."""
    return hits.agg(*total_columns())


def _option(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.alias("value"))


def gender_options() -> Column:
    """Options of the gender chart: all hits not marked male count as female."""
    male = percent(F.col("male"), F.col("total"))
    return F.array(_option(K.GENDER_MALE, male), _option(K.GENDER_FEMALE, rest(male)))


def age_options() -> Column:
    young, old = percent(F.col("young"), F.col("total")), percent(F.col("old"), F.col("total"))
    return F.array(
        _option(K.AGE_YOUNG, young), _option(K.AGE_MIDDLE, rest(young, old)), _option(K.AGE_OLD, old)
    )


def share_rows(hit_totals: DataFrame, title: str, options: Column) -> DataFrame:
    return hit_totals.select(F.lit(title).alias("title"), F.inline(options))


def gender_share(hits: DataFrame) -> DataFrame:
    return share_rows(totals(hits), K.GENDER_TITLE, gender_options())


def age_share(hits: DataFrame) -> DataFrame:
    return share_rows(totals(hits), K.AGE_TITLE, age_options())
