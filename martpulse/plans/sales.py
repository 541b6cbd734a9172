"""The wide sale table: orders, their lines and their buyers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martpulse.functions.times import age_years
from martpulse.operators.joins import full_outer
from martpulse.schemas import SALE_DETAIL_COLUMNS


def order_part(orders: DataFrame, *keep: str) -> DataFrame:
    return orders.select(
        F.col("id").alias("order_id"), "order_status", "create_time", F.col("create_date").alias("dt"), "user_id",
        *keep,
    )


def detail_part(details: DataFrame, *keep: str) -> DataFrame:
    return details.select(
        F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_name",
        F.col("order_price").try_cast("double").alias("sku_price"), *keep,
    )


def user_part(users: DataFrame, as_of: Column) -> DataFrame:
    return users.select(
        F.col("id").alias("user_id"),
        F.col("gender").alias("user_gender"),
        age_years(F.col("birthday"), as_of).alias("user_age"),
        "user_level",
        F.lit(True).alias("_known"),
    )


def default_age() -> Column:
    """Sales whose buyer is not on record carry age 0."""
    return F.when(F.col("_known"), F.col("user_age")).otherwise(F.lit(0)).alias("user_age")


def with_users(orders: DataFrame, users: DataFrame, as_of: str) -> DataFrame:
    """Buyer fields for rows with a ``user_id``; those without a known buyer stay."""
    joined = orders.join(user_part(users, F.lit(as_of).cast("date")), "user_id", "left")
    return joined.withColumn("user_age", default_age()).drop("_known")


def sold_lines(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Order lines with their order, buyer fields left out."""
    return order_part(orders).join(detail_part(details), "order_id")


def sale_detail(
    orders: DataFrame, details: DataFrame, users: DataFrame, as_of: str, buyers_first: bool = True
) -> DataFrame:
    """One row per order line, with order and buyer.

    For the whole table buyers are joined to orders before the lines come in: the many lines are then shuffled by
    order only, never by buyer, and a buyer with a large share of the orders is met at order grain. Where a filter
    leaves few lines, ``buyers_first=False`` looks up buyers for the lines that are left.
    """
    if buyers_first:
        sold = with_users(order_part(orders), users, as_of).join(detail_part(details), "order_id")
    else:
        sold = with_users(sold_lines(orders, details), users, as_of)
    return sold.select(*SALE_DETAIL_COLUMNS)


def within_expiry(order_ts: Column, detail_ts: Column, expiry: str, early_details: str = "buffer") -> Column:
    """The two records come at most ``expiry`` apart.

    ``early_details='buffer'`` also lets a line wait for its order; ``'drop'`` takes only lines not before it.
    """
    span = F.expr(f"interval {expiry}")
    upper = detail_ts <= order_ts + span
    if early_details == "drop":
        return (detail_ts >= order_ts) & upper
    if early_details != "buffer":
        raise ValueError("early_details is 'buffer' or 'drop'")
    return (detail_ts >= order_ts - span) & upper


def expiring_sales(orders: DataFrame, details: DataFrame, expiry: str, early_details: str = "buffer") -> DataFrame:
    """Order lines that meet their order in time; orders have ``order_ts``, lines ``detail_ts``."""
    joined = order_part(orders, "order_ts").join(detail_part(details, "detail_ts"), "order_id")
    return joined.where(within_expiry(F.col("order_ts"), F.col("detail_ts"), expiry, early_details))


def unmatched_orders(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Orders without any line."""
    keys = details.select("order_id").distinct()
    return order_part(orders).join(keys, "order_id", "left_anti")


def joined_or_alone(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Full outer join of lines and orders, each row marked ``matched``, ``order_only`` or ``detail_only``."""
    one = order_part(orders).withColumn("_order", F.lit(True))
    many = detail_part(details).withColumn("_detail", F.lit(True))
    status = (
        F.when(F.col("_order") & F.col("_detail"), "matched")
        .when(F.col("_order"), "order_only")
        .otherwise("detail_only")
    )
    return full_outer(many, one, "order_id").withColumn("status", status).drop("_order", "_detail")
