"""Streaming jobs run to the end over replayed feeds; each returns its table and the progress reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martpulse import schemas
from martpulse.session import stream_session, work_dir
from martpulse.sources.feeds import file_changes, file_feed
from martpulse.sources.sinks import read_all, read_latest
from martpulse.streaming import jobs
from martpulse.streaming.replay import replay

NOW = {"availableNow": True}
PIECES = 2


class _Folders:
    """Fresh folders of one run, all below the shared one."""

    def __init__(self, spark: SparkSession, name: str):
        self.root = work_dir(spark, name)
        self.table, self.checkpoint = f"{self.root}/table", f"{self.root}/checkpoint"

    def feed(self, name: str) -> str:
        return f"{self.root}/feed-{name}"


def first_logins(spark: SparkSession, feed: DataFrame, pieces: int = PIECES):
    at, streams = _Folders(spark, "devices"), stream_session(spark)
    source = at.feed("startup")
    reports = replay(
        {source: feed},
        lambda: jobs.start_devices(file_feed(streams, source), at.table, at.checkpoint, NOW),
        pieces,
    )
    return read_all(spark, at.table, jobs.DEVICE_TABLE), reports


def late_logins(spark: SparkSession, feed: DataFrame, late: str = "1 hour", pieces: int = 3):
    """Feeds whose rows come in any order: landed, counted where on time, folded in where late."""
    at, streams = _Folders(spark, "late-devices"), stream_session(spark)
    source, logs, corrections = at.feed("startup"), f"{at.root}/landed", f"{at.root}/corrections"
    reports = replay(
        {source: feed},
        [
            lambda: jobs.start_landing(
                file_feed(streams, source), schemas.STARTUP_LOG, logs, f"{at.root}/landing-checkpoint", NOW, late, "day"
            ),
            lambda: jobs.start_landed_devices(streams, logs, at.table, at.checkpoint, NOW, late),
            lambda: jobs.start_late_devices(streams, logs, at.table, corrections, f"{at.root}/late-checkpoint", NOW),
        ],
        pieces,
    )
    return jobs.stored_devices(spark, at.table, corrections), reports


def first_seen(spark: SparkSession, feed: DataFrame, pieces: int = PIECES):
    """The device table, and the folder of the devices by the day they were first seen."""
    at, streams = _Folders(spark, "first-seen"), stream_session(spark)
    source, seen = at.feed("startup"), f"{at.root}/seen"
    reports = replay(
        {source: feed},
        [
            lambda: jobs.start_devices(file_feed(streams, source), at.table, at.checkpoint, NOW),
            lambda: jobs.start_first_seen(streams, at.table, seen, f"{at.root}/seen-checkpoint", NOW, buckets=4),
        ],
        pieces,
    )
    return jobs.stored_devices(spark, at.table), seen, reports


def unseen_logins(spark: SparkSession, logs: DataFrame, batches: int = 24) -> DataFrame:
    """First logins over one batch per hour of the day, each held against the devices that batches before it have stored."""
    at = _Folders(spark, "unseen")
    hour = F.hour("ts")
    for number in range(batches):
        jobs.write_unseen(logs.where(F.floor(hour * batches / 24) == number), number, at.table, buckets=1)
    return spark.read.option("basePath", at.table).parquet(at.table)


def alert_documents(spark: SparkSession, feed: DataFrame, window: str, slide: str, pieces: int = PIECES, late: str = "5 seconds"):
    at, streams = _Folders(spark, "alerts"), stream_session(spark)
    source, events, corrections = at.feed("event"), f"{at.root}/landed", f"{at.root}/corrections"
    # A far-off tick closes the windows at the end of the feed.
    tick = F.to_json(F.struct(F.lit("tick").alias("mid"), F.lit("tick").alias("evid"), F.lit(4102444800000).alias("ts")))
    closing = spark.range(1).select(
        F.lit("event").alias("topic"), tick.alias("value"), F.timestamp_millis(F.lit(4102444800000)).alias("timestamp")
    )
    reports = replay(
        {source: feed},
        [
            lambda: jobs.start_landing(
                file_feed(streams, source), schemas.EVENT_LOG, events, f"{at.root}/landing-checkpoint", NOW, late, "day"
            ),
            lambda: jobs.start_alerts(
                streams, events, at.table, at.checkpoint, NOW, window=window, slide=slide, late=late
            ),
            lambda: jobs.start_late_alerts(
                streams, events, corrections, f"{at.root}/late-checkpoint", NOW, window=window, slide=slide
            ),
        ],
        pieces,
        closing={source: closing},
    )
    return jobs.stored_alerts(spark, at.table, corrections), reports


def unmatched(spark: SparkSession, orders: DataFrame, details: DataFrame, expiry: str, pieces: int = PIECES):
    at, streams = _Folders(spark, "unmatched"), stream_session(spark)
    order_source, detail_source = at.feed("order"), at.feed("detail")
    # A far-off order and line end the wait of all others.
    tick = F.to_json(F.struct(F.lit("tick").alias("id"), F.lit("tick").alias("order_id")))
    closing = spark.range(1).select(
        F.lit("tick").alias("topic"), tick.alias("value"), F.timestamp_millis(F.lit(4102444800000)).alias("timestamp"),
        F.lit(None).cast("int").alias("pos"),
    )
    reports = replay(
        {order_source: orders, detail_source: details},
        lambda: jobs.start_unmatched(
            file_feed(streams, order_source), file_feed(streams, detail_source), at.table, at.checkpoint, NOW, expiry
        ),
        pieces,
        closing={order_source: closing, detail_source: closing},
    )
    return read_all(spark, at.table, jobs.UNMATCHED_TABLE), reports


def sale_documents(
    spark: SparkSession, orders: DataFrame, details: DataFrame, users: DataFrame, expiry: str, as_of: str,
    pieces: int = PIECES, **options,
):
    at, streams = _Folders(spark, "sales"), stream_session(spark)
    order_source, detail_source, user_table = at.feed("order"), at.feed("detail"), f"{at.root}/users"
    user_source = at.feed("user")
    replay(
        {user_source: users},
        lambda: jobs.start_users(file_feed(streams, user_source), user_table, f"{at.root}/users-checkpoint", NOW), 1,
    )
    reports = replay(
        {order_source: orders, detail_source: details},
        lambda: jobs.start_sales(
            file_feed(streams, order_source), file_feed(streams, detail_source),
            lambda buyers: jobs.current_users(buyers.sparkSession, user_table, buyers),
            at.table, at.checkpoint, as_of, NOW, period="month", expiry=expiry, words=f"{at.table}-words", **options,
        ),
        pieces,
    )
    return at.table, reports  # the word index lies beside the table


def order_rows(spark: SparkSession, feed: DataFrame, pieces: int = PIECES):
    at, streams = _Folders(spark, "orders"), stream_session(spark)
    source = at.feed("order")
    reports = replay(
        {source: feed},
        lambda: jobs.start_orders(file_feed(streams, source), at.table, at.checkpoint, NOW, period="month"),
        pieces,
    )
    return jobs.stored_orders(spark, at.table), reports


def backfilled_orders(spark: SparkSession, feed: DataFrame, old: DataFrame):
    """An order table whose job is followed by one with a new checkpoint over an older feed, then folded."""
    at, streams = _Folders(spark, "backfill"), stream_session(spark)
    for number, rows in enumerate((feed, old)):
        source = at.feed(f"order-{number}")
        replay(
            {source: rows},
            lambda: jobs.start_orders(file_feed(streams, source), at.table, f"{at.checkpoint}-{number}", NOW, period="month"),  # noqa: B023
            1,
        )
    months = [r.m for r in read_all(spark, at.table, jobs.ORDER_TABLE).select(F.col("create_period").alias("m")).distinct().collect()]
    for _ in range(2):
        jobs.fold_orders(spark, at.table, months)
    return jobs.stored_orders(spark, at.table)


def users(spark: SparkSession, feed: DataFrame, pieces: int = 2):
    at, streams = _Folders(spark, "users"), stream_session(spark)
    source = at.feed("user")
    reports = replay(
        {source: feed.select("topic", "value", "timestamp", "pos")},
        lambda: jobs.start_users(file_feed(streams, source), at.table, at.checkpoint, NOW),
        pieces,
    )
    return jobs.current_users(spark, at.table), reports


def change_rows(spark: SparkSession, entries: DataFrame, pieces: int = PIECES):
    at, streams = _Folders(spark, "changes"), stream_session(spark)
    source = at.feed("entries")
    reports = replay(
        {source: entries},
        lambda: jobs.start_changes(
            file_changes(streams, source), at.table, at.checkpoint, NOW
        ),
        pieces,
        time="exec_time",
    )
    return spark.read.schema("topic STRING, value STRING, timestamp TIMESTAMP, pos INT").parquet(at.table), reports
