"""The totals panel and the two-day hour charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martpulse import constants as K
from martpulse.plans import devices, orders as order_plans


def kpi_totals(logs: DataFrame, orders: DataFrame, date: str | None = None, order_date: str | None = None) -> DataFrame:
    """Rows (id, name, value): active devices, new devices and turnover of a day (turnover may have its own).

    From logs alone, which takes their whole history; the tables that the jobs write answer it by :func:`kpi_stored`.
    """
    return _cards(devices.day_counts(logs, date), order_plans.turnover(orders, order_date or date))


def kpi_stored(
    table: DataFrame, new: DataFrame, orders: DataFrame, date: str | None = None, order_date: str | None = None
) -> DataFrame:
    """:func:`kpi_totals` from the device table, the devices first seen on the day and the order table: no history."""
    return _cards(devices.stored_counts(table, new, date), order_plans.turnover(orders, order_date or date))


def _cards(counts: DataFrame, turnover: DataFrame) -> DataFrame:
    cards = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(key).alias("id"), F.lit(label).alias("name"), F.col(key).cast("double").alias("value")
                    )
                    for key, label in (K.CARD_DAU, K.CARD_NEW_MID)
                ]
            )
        )
    )
    amount = turnover.select(
        F.lit(K.CARD_AMOUNT[0]).alias("id"), F.lit(K.CARD_AMOUNT[1]).alias("name"),
        F.col("sum_amount").alias("value"),
    )
    return cards.unionByName(amount)


def kpi_json(logs: DataFrame, orders: DataFrame, date: str | None = None, order_date: str | None = None) -> DataFrame:
    """The three cards as one row with a JSON list."""
    cards = kpi_totals(logs, orders, date, order_date)
    order = F.array_position(F.array(*[F.lit(k[0]) for k in (K.CARD_DAU, K.CARD_NEW_MID, K.CARD_AMOUNT)]), F.col("id"))
    listed = F.array_sort(F.collect_list(F.struct(order.alias("pos"), "id", "name", "value")))
    plain = F.transform(listed, lambda c: F.struct(c["id"].alias("id"), c["name"].alias("name"), c["value"].alias("value")))
    return cards.agg(F.to_json(plain).alias("response"))


def hourly_compare(metric: str, source: DataFrame, date: str | None = None, filled: bool = True) -> DataFrame:
    """Rows (hour, yesterday, today) of one metric, 24 in all (and one for odd hours); unfilled, those with values.

    Devices are counted from logs, or from the device table, which has ``log_date``.
    """
    if metric == K.CARD_DAU[0]:
        stored = "log_date" in source.columns and "batch_id" in source.columns
        return (devices.stored_hours_compared if stored else devices.hours_compared)(source, date, filled)
    if metric == K.CARD_AMOUNT[0]:
        return order_plans.hours_compared(source, date, filled)
    raise ValueError(f"no hour series for {metric}")


def hourly_json(metric: str, source: DataFrame, date: str | None = None) -> DataFrame:
    """The series of both days as one row of JSON, hours without a value left out."""
    series = hourly_compare(metric, source, date, filled=False)

    def of(day: str):
        pairs = F.array_sort(F.collect_list(F.when(F.col(day).isNotNull(), F.struct("hour", day))))
        return F.map_from_entries(pairs).alias(day)

    return series.agg(F.to_json(F.struct(of("yesterday"), of("today"))).alias("response"))
