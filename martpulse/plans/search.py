"""Keyword search over the wide sale table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martpulse import constants as K
from martpulse.functions.texts import has_all_words, relevance
from martpulse.operators import facets
from martpulse.operators.paging import page_after, page_of
from martpulse.schemas import SALE_DETAIL_COLUMNS


def hits(sales: DataFrame, keyword: str, date: str | None = None) -> DataFrame:
    """Sales of the day (of all days without one) whose goods carry every word of the keyword."""
    found = sales.where(has_all_words(F.col("sku_name"), keyword))
    return found.where(F.col("dt") == date) if date else found


def scored(sales: DataFrame, keyword: str, date: str | None = None) -> DataFrame:
    """Hits with their ``score``."""
    return hits(sales, keyword, date).withColumn("score", relevance(F.col("sku_name"), keyword))


def page(sales: DataFrame, keyword: str, date: str | None = None, page: int = 1, size: int = 20) -> DataFrame:
    """One page of hits, best match first, ids in order among equals; for the first pages, :func:`next_page` goes as deep as wanted."""
    return page_of(scored(sales, keyword, date), [F.desc("score"), F.asc("order_detail_id")], page, size)


def next_page(
    sales: DataFrame, keyword: str, date: str | None = None, after: tuple[float, str] | None = None, size: int = 20
) -> DataFrame:
    """The hits after the one with score and id ``after``, or the first ones: a walk over all pages."""
    return page_after(scored(sales, keyword, date), "score", "order_detail_id", after, size)


def total(sales: DataFrame, keyword: str, date: str | None = None) -> DataFrame:
    return hits(sales, keyword, date).agg(F.count("*").alias("total"))


def _stat(title: str, options):
    return F.struct(options.alias("options"), F.lit(title).alias("title"))


def observed_page(
    sales: DataFrame, keyword: str, date: str | None = None, page_no: int = 1, size: int = 20
) -> tuple[DataFrame, Observation]:
    """A page, and the totals of all hits, which are observed as they pass on their way to it: one pass for both."""
    totals = Observation()
    rows = scored(sales, keyword, date).observe(totals, *facets.total_columns())
    return page_of(rows, [F.desc("score"), F.asc("order_detail_id")], page_no, size), totals


def response(sales: DataFrame, keyword: str, date: str | None = None, page_no: int = 1, size: int = 20) -> DataFrame:
    """The whole answer as one row of JSON: total, the page's rows and both charts.

    The page is fetched here (at most ``size`` rows and four numbers), so the tables are read once.
    """
    rows, totals = observed_page(sales, keyword, date, page_no, size)
    spark, schema = sales.sparkSession, rows.select(*SALE_DETAIL_COLUMNS).schema.simpleString()
    found = [tuple(r[c] for c in SALE_DETAIL_COLUMNS) for r in rows.collect()]
    counts = totals.get
    answer = spark.createDataFrame([(found, *(counts[c] for c in ("total", "male", "young", "old")))], (
        f"detail array<{schema}>, total bigint, male bigint, young bigint, old bigint"
    ))
    stat = F.array(_stat(K.GENDER_TITLE, facets.gender_options()), _stat(K.AGE_TITLE, facets.age_options()))
    return answer.select(F.to_json(F.struct("total", "detail", stat.alias("stat"))).alias("response"))
