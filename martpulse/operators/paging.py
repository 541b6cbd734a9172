"""Pages of a sorted result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_of(df: DataFrame, order: list[Column], page: int, size: int) -> DataFrame:
    """Page ``page`` (from 1) of ``size`` rows. Spark takes the top rows of each task, without a full sort."""
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


def page_after(df: DataFrame, score: str, row_id: str, after: tuple[float, str] | None, size: int) -> DataFrame:
    """The ``size`` rows that follow the row ``after`` = (score, id), best score first and ids in order among equals.

    Whatever the place in the result, each task gives ``size`` rows and no more; the last row's score and id lead to the next page.
    """
    if size < 1:
        raise ValueError("size starts at 1")
    if after is not None:
        best, last = F.lit(float(after[0])), F.lit(after[1])
        df = df.where((F.col(score) < best) | ((F.col(score) == best) & (F.col(row_id) > last)))
    return df.orderBy(F.desc(score), F.asc(row_id)).limit(size)
