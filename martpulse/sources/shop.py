"""The shop's record views over the TPC-H-like tables in a folder.

The tables stand in for the shop's own feeds: events for the device logs, orders and lines for the order
tables, customers for users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martpulse.functions.times import date_text, hour_text

AS_OF = "2024-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def startup_log(spark: SparkSession, folder: str) -> DataFrame:
    """One row per start of the app on a device."""
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.col("event_type").alias("type"),
        "ts",
    )


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Actions in the app, on ten shared devices so that a device sees several users."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id",
        (F.col("user_id") % 10).cast("string").alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.when(kind == "signup", "coupon")
        .when(kind == "click", "clickItem")
        .when(kind == "purchase", "addCart")
        .when(kind == "view", "addComment")
        .otherwise("error")
        .alias("evid"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("itemid"),
        "ts",
    )


def order_heads(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without buyer fields. Order dates have no time, so the time of day is derived from the number."""
    number = F.col("o_orderkey")
    clock = [F.lpad((number % unit).cast("string"), 2, "0") for unit in (24, 60, 60)]
    date = date_text(F.col("o_orderdate"))
    return table(spark, folder, "orders").select(
        number.cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("payment_way"),
        F.concat_ws(" ", date, F.concat_ws(":", *clock)).alias("create_time"),
        date.alias("create_date"),
        clock[0].alias("create_hour"),
        F.col("o_orderdate").alias("order_ts"),
    )


def order_info(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the buyer fields that the order feed carries."""
    buyers = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_nationkey").cast("string").alias("province_id"),
        F.col("c_name").alias("consignee"),
        F.concat(F.lit("13"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("consignee_tel"),
    )
    return order_heads(spark, folder).join(buyers, "user_id", "left")


def order_detail(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the name of the goods; prices stay numbers, the feed makes them texts."""
    lines = table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").alias("p_partkey"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        F.col("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("int").cast("string").alias("sku_num"),
        F.col("l_shipdate").alias("detail_ts"),
    )
    goods = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("sku_name"))
    return lines.join(goods, "p_partkey", "left").drop("p_partkey")


def user_info(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        number.cast("string").alias("id"),
        F.col("c_name").alias("login_name"),
        (F.col("c_nationkey") % 5 + 1).cast("string").alias("user_level"),
        F.date_add(F.lit("1965-01-01").cast("date"), ((number * 37) % 16000).cast("int")).alias("birthday"),
        F.when(number % 2 == 0, "M").otherwise("F").alias("gender"),
    )


def provinces(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("string").alias("province_id"), F.col("n_name").alias("name")
    )


# --- change log ---------------------------------------------------------------------------------


def _image(*columns: str):
    """A row's after-image as a list of (name, text)."""
    return F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]
    )


def _entries(rows: DataFrame, table_name: str, event: str, images, when, kind: str = "ROWDATA") -> DataFrame:
    return rows.select(
        F.lit(kind).alias("entry_type"),
        F.lit(table_name).alias("table_name"),
        F.lit(event).alias("event_type"),
        when.cast("timestamp").alias("exec_time"),
        images.alias("rows"),
    )


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    """Change entries of a shop database over its whole tables.

    Orders and lines are inserted, finished orders are also updated, users are inserted and then updated (one
    entry with two row images); each order's transaction mark and the province table are there to be ignored.
    """
    orders = order_heads(spark, folder)
    order_image = _image("id", "user_id", "order_status", "total_amount", "create_time")
    lines = table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("int").alias("sku_num"),
        "l_shipdate",
    )
    users = user_info(spark, folder)
    promoted = users.withColumn("next_level", (F.col("user_level").cast("int") + 1).cast("string"))
    user_image = _image("id", "login_name", "user_level", "birthday", "gender")
    next_image = F.transform(
        user_image,
        lambda c: F.struct(
            c["name"].alias("name"),
            F.when(c["name"] == "user_level", F.col("next_level")).otherwise(c["value"]).alias("value"),
        ),
    )
    start = F.lit("1990-01-01 00:00:00").cast("timestamp")
    parts = [
        _entries(orders, "order_info", "INSERT", F.array(order_image), F.col("order_ts")),
        _entries(
            orders.where("order_status = 'F'"), "order_info", "UPDATE", F.array(order_image), F.col("order_ts")
        ),
        _entries(
            orders, "order_info", "INSERT", F.array(order_image), F.col("order_ts"), "TRANSACTIONBEGIN"
        ),
        _entries(
            lines,
            "order_detail",
            "INSERT",
            F.array(_image("id", "order_id", "sku_id", "order_price", "sku_num")),
            F.col("l_shipdate"),
        ),
        _entries(users, "user_info", "INSERT", F.array(user_image), start),
        _entries(
            promoted, "user_info", "UPDATE", F.array(user_image, next_image), start + F.expr("interval 1 day")
        ),
        _entries(
            provinces(spark, folder), "base_province", "INSERT", F.array(_image("province_id", "name")), start
        ),
    ]
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return log
