"""Dates, hours and ages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Milliseconds of the years 1 to 9999; other numbers are no times, and the largest would overflow.
FIRST_MILLI, LAST_MILLI = -62135596800000, 253402300799999


def is_millis(ms: Column) -> Column:
    return ms.between(FIRST_MILLI, LAST_MILLI)


def from_millis(ms: Column) -> Column:
    """The time, or NULL for numbers that are none."""
    return F.timestamp_millis(F.when(is_millis(ms), ms))


def micros(interval: str) -> Column:
    """Length of an interval of days or shorter units, such as ``5 minutes``, in microseconds."""
    return F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval '{interval}'"))


def date_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def hour_text(ts: Column) -> Column:
    return F.date_format(ts, "HH")


def text_date(text: Column) -> Column:
    """Date part of ``yyyy-MM-dd HH:mm:ss``; empty when there is none."""
    return F.split_part(text, F.lit(" "), F.lit(1))


def text_hour(text: Column) -> Column:
    """Hour part of ``yyyy-MM-dd HH:mm:ss``; empty when there is none."""
    return F.split_part(F.split_part(text, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))


def age_years(birthday: Column, as_of: Column) -> Column:
    """Whole years of 365 days, cut towards zero."""
    return (F.datediff(as_of, birthday) / 365).cast("int")


def hour_key(hour: Column) -> Column:
    return F.lpad(hour.cast("string"), 2, "0")


def day(date: str | None) -> Column:
    """The given day, or today."""
    return F.lit(date).cast("date") if date else F.current_date()


def within_days(df: DataFrame, column: str, date: str | None, before: int = 0) -> DataFrame:
    """Rows whose time lies on ``date`` or up to ``before`` days earlier.

    Compares the bare column with bounds of its own type, so that the filter reaches the file scan.
    """
    kind = df.schema[column].dataType
    start = F.date_sub(day(date), before).cast(kind)
    end = F.date_add(day(date), 1).cast(kind)
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def up_to_day(df: DataFrame, column: str, date: str | None) -> DataFrame:
    """Rows whose time lies on ``date`` or earlier."""
    return df.where(F.col(column) < F.date_add(day(date), 1).cast(df.schema[column].dataType))
