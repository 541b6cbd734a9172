"""Daily active devices.

Input rows have at least ``mid`` and ``ts``; ``event_id`` breaks ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martpulse.functions.times import date_text, day, hour_text, up_to_day, within_days
from martpulse.operators.hours import fill_hours
from martpulse.operators.keyed import first_per


def dated(logs: DataFrame) -> DataFrame:
    return logs.withColumn("log_date", date_text(F.col("ts"))).withColumn("log_hour", hour_text(F.col("ts")))


def first_logins(logs: DataFrame) -> DataFrame:
    """The whole first row of each device and day."""
    return first_per(dated(logs), ["mid", "log_date"], ["ts", "event_id"])


def _active(logs: DataFrame) -> DataFrame:
    """One row per device and day with the time of its first log; reads two columns, hashes fixed-size values."""
    return logs.groupBy("mid", F.col("ts").cast("date").alias("day")).agg(F.min("ts").alias("first_ts"))


def daily_total(logs: DataFrame) -> DataFrame:
    """Active devices of every day."""
    devices = logs.select("mid", F.col("ts").cast("date").alias("day")).distinct()
    counts = devices.groupBy("day").agg(F.count("*").alias("dau"))
    return counts.select(F.col("day").cast("string").alias("log_date"), "dau")


def total(logs: DataFrame, date: str | None = None) -> DataFrame:
    """Active devices of one day, as one row."""
    return within_days(logs, "ts", date).select("mid").distinct().agg(F.count("*").alias("dau"))


def by_hour(logs: DataFrame, date: str | None = None) -> DataFrame:
    """Devices of one day by the hour of their first log; hours without any are absent."""
    active = _active(within_days(logs, "ts", date))
    return active.groupBy(hour_text(F.col("first_ts")).alias("hour")).agg(F.count("*").alias("value"))


def _compared(active: DataFrame, is_today: Column, hour: Column, filled: bool) -> DataFrame:
    """Devices of two days by hour; unfilled, an hour without devices of a day is NULL there."""
    series = active.groupBy(hour.alias("hour")).agg(
        F.nullif(F.count_if(~is_today), F.lit(0)).alias("yesterday"), F.nullif(F.count_if(is_today), F.lit(0)).alias("today")
    )
    return fill_hours(series, ["yesterday", "today"]) if filled else series


def hours_compared(logs: DataFrame, date: str | None = None, filled: bool = True) -> DataFrame:
    """24 hours, the day before next to the day; one scan of both days."""
    active = _active(within_days(logs, "ts", date, before=1))
    return _compared(active, F.col("day") == day(date), hour_text(F.col("first_ts")), filled)


# --- the same questions to the table that the device job writes: (mid, log_date, log_hour), days as text ---


def _stored(table: DataFrame, date: str | None, before: int = 0) -> DataFrame:
    """Each device of the day once, with its earliest hour; ``log_date`` is the table's partition."""
    dates = [F.date_sub(day(date), back).cast("string") for back in range(before + 1)]
    rows = table.where(F.col("log_date").isin(*dates))
    return rows.groupBy("mid", "log_date").agg(F.min("log_hour").alias("hour"))


def stored_total(table: DataFrame, date: str | None = None) -> DataFrame:
    return _stored(table, date).agg(F.count("*").alias("dau"))


def stored_by_hour(table: DataFrame, date: str | None = None) -> DataFrame:
    return _stored(table, date).groupBy("hour").agg(F.count("*").alias("value"))


def stored_hours_compared(table: DataFrame, date: str | None = None, filled: bool = True) -> DataFrame:
    is_today = F.col("log_date") == day(date).cast("string")
    return _compared(_stored(table, date, before=1), is_today, F.col("hour"), filled)


def first_seen(logs: DataFrame) -> DataFrame:
    """(mid, first_date): the day each device was first seen, the table that new devices are counted from."""
    return logs.groupBy("mid").agg(F.min(F.col("ts").cast("date")).alias("first_date"))


def day_counts_from(logs: DataFrame, seen: DataFrame, date: str | None = None) -> DataFrame:
    """:func:`day_counts` from one day of logs and the first-seen table, without history."""
    active = within_days(logs, "ts", date).select("mid").distinct()
    new = seen.where(F.col("first_date") == day(date)).select("mid", F.lit(1).alias("new"))
    return active.join(new, "mid", "left").agg(F.count("*").alias("dau"), F.count("new").alias("new_mid"))


def stored_counts(table: DataFrame, new: DataFrame, date: str | None = None) -> DataFrame:
    """:func:`day_counts` from the device table's day and the devices first seen on it (``mid``)."""
    active = _stored(table, date).select("mid")
    fresh = new.select("mid", F.lit(1).alias("new"))
    return active.join(fresh, "mid", "left").agg(F.count("*").alias("dau"), F.count("new").alias("new_mid"))


def new_devices(logs: DataFrame) -> DataFrame:
    """For each day, devices never seen before it."""
    first = logs.groupBy("mid").agg(F.min("ts").alias("first_ts"))
    days = first.groupBy(F.col("first_ts").cast("date").alias("day")).agg(F.count("*").alias("new_mid"))
    return days.select(F.col("day").cast("string").alias("log_date"), "new_mid")


def day_counts(logs: DataFrame, date: str | None = None) -> DataFrame:
    """One row: devices active on the day, and those of them never seen before. One scan for both."""
    start = day(date).cast(logs.schema["ts"].dataType)
    devices = up_to_day(logs, "ts", date).groupBy("mid").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    return devices.agg(
        F.count_if(F.col("last_ts") >= start).alias("dau"),
        F.count_if(F.col("first_ts") >= start).alias("new_mid"),
    )
