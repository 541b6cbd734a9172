"""Orders and turnover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martpulse.constants import ORDER_COLUMNS
from martpulse.functions.numbers import colour_band, money_sum
from martpulse.functions.texts import mask_tel
from martpulse.functions.times import day, text_date, text_hour, within_days
from martpulse.operators.hours import fill_hours


def order_rows(orders: DataFrame, *keep: str) -> DataFrame:
    """Parsed orders as rows of the order table: date and hour split off, phone masked."""
    return (
        orders.withColumn("create_date", text_date(F.col("create_time")))
        .withColumn("create_hour", text_hour(F.col("create_time")))
        .withColumn("consignee_tel", mask_tel(F.col("consignee_tel")))
        .select(*ORDER_COLUMNS, *keep)
    )


def of_days(orders: DataFrame, date: str | None, before: int = 0) -> DataFrame:
    """Orders of a day. ``order_ts``, where there is one, is a stored column: filtering it prunes the scan."""
    if "order_ts" in orders.columns:
        return within_days(orders, "order_ts", date, before)
    dates = [F.date_sub(day(date), back).cast("string") for back in range(before + 1)]
    if "create_period" in orders.columns:  # the partition of the order table: a day or a month
        orders = orders.where(F.col("create_period").isin(*dates, *[F.substring(d, 1, 7) for d in dates]))
    return orders.where(F.col("create_date").isin(*dates))


def turnover(orders: DataFrame, date: str | None = None) -> DataFrame:
    """Sum of a day; NULL when it has no orders."""
    return of_days(orders, date).agg(money_sum(F.col("total_amount")).alias("sum_amount"))


def daily_turnover(orders: DataFrame) -> DataFrame:
    return orders.groupBy("create_date").agg(money_sum(F.col("total_amount")).alias("sum_amount"))


def turnover_by_hour(orders: DataFrame, date: str | None = None) -> DataFrame:
    return (
        of_days(orders, date)
        .groupBy(F.col("create_hour").alias("hour"))
        .agg(money_sum(F.col("total_amount")).alias("value"))
    )


def hours_compared(orders: DataFrame, date: str | None = None, filled: bool = True) -> DataFrame:
    """24 hours, the day before next to the day; one scan of both days."""
    is_today = F.col("create_date") == day(date).cast("string")
    amount = F.col("total_amount")
    series = (
        of_days(orders, date, before=1)
        .groupBy(F.col("create_hour").alias("hour"))
        .agg(
            money_sum(F.when(~is_today, amount)).alias("yesterday"),
            money_sum(F.when(is_today, amount)).alias("today"),
        )
    )
    return fill_hours(series, ["yesterday", "today"]) if filled else series


def regional_sales(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    """Orders and turnover per province, names joined after the aggregation."""
    sums = orders.groupBy("province_id").agg(
        F.count("*").alias("order_count"), money_sum(F.col("total_amount")).alias("value")
    )
    return sums.join(provinces, "province_id", "left").select("province_id", "name", "order_count", "value")


def regional_bands(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    """Province, number of orders and colour band of the map."""
    sales = regional_sales(orders, provinces)
    return sales.select("name", F.col("order_count").alias("value"), colour_band(F.col("order_count")).alias("band"))
