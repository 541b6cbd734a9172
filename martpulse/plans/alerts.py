"""Coupon alerts: several users take coupons on one device and nobody there looks at goods.

Event rows have ``mid``, ``uid``, ``evid``, ``itemid`` and ``ts``. Time is cut into panes as long as the window's
slide, and a window is named by the pane it ends with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martpulse import constants as K
from martpulse.functions.times import micros


def is_coupon() -> Column:
    return F.col("evid") == K.COUPON


def is_click() -> Column:
    return F.col("evid") == K.CLICK_ITEM


def windows_of_panes(window: str, slide: str) -> Column:
    return F.window(F.window_time("pane"), window, slide)


def minute_id(mid: Column, at: Column) -> Column:
    """Document id: device and minute, so an alert that fires again within the minute replaces itself."""
    return F.concat_ws("_", mid, F.floor(F.unix_seconds(at.cast("timestamp")) / 60).cast("string"))


def detect(
    events: DataFrame, window: str = K.ALERT_WINDOW, slide: str = K.ALERT_SLIDE, min_users: int = K.ALERT_MIN_USERS,
    block: str = "1 day",
) -> DataFrame:
    """Rows (mid, window_start, window_end, uid_count) of all alerts; ``window`` is a multiple of ``slide``.

    A row is not copied into the many windows that hold it. Each mark (a user's coupons, or clicks, of a device in
    a pane) counts for the windows that end from its pane up to the same user's next mark or the window's length,
    so a window counts a user once. Where such a span begins, the device's count rises by one, where it ends, it
    falls; running sums over these steps give the count of every window. Marks are made distinct before the
    shuffle and a device has at most one step per pane, so no group grows with the number of events.

    Time is cut into blocks (of a window's length at least), and a device's blocks are worked on apart, so its history
    is spread over tasks. Spans are no longer than a window: marks of a block's first panes are shown to the block before,
    which may have to end a span there, and a span over an edge is cut in two, so that sums start from nothing in each block.
    """
    spark = events.sparkSession
    step, length, cut = spark.range(1).select(micros(slide), micros(window), micros(block)).first()
    if length % step:
        raise ValueError("the window must be a multiple of its slide")
    if min_users < 1:
        raise ValueError("an alert has one user at least")
    panes = length // step
    in_block = max(cut // step, panes)
    named = events.where(F.col("mid").isNotNull())  # rows without a device belong to no device
    marks = named.where(is_click() | (is_coupon() & F.col("uid").isNotNull())).select(
        "mid",
        F.when(is_coupon(), F.col("uid")).alias("user"),
        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / step).alias("pane"),
    ).distinct()
    own = F.floor(F.col("pane") / in_block)
    shown = F.when(F.col("pane") - own * in_block < panes, F.array(own, own - 1)).otherwise(F.array(own))
    following = F.lead("pane").over(Window.partitionBy("mid", "user", "block").orderBy("pane"))
    last = F.least(following - 1, F.col("pane") + (panes - 1))
    spans = (
        marks.withColumn("block", F.explode(shown))
        .select(
            "mid", "block", "pane", last.alias("last"), F.col("user").isNotNull().cast("int").alias("users"),
            F.col("user").isNull().cast("int").alias("clicks"),
        )
        .where(own == F.col("block"))
    )
    edge = (F.col("block") + 1) * in_block  # first pane of the next block

    def change(place: Column, pane: Column, sign: int) -> Column:
        return F.struct(
            place.alias("block"), pane.alias("pane"), (sign * F.col("users")).alias("users"), (sign * F.col("clicks")).alias("clicks")
        )

    here = [change(F.col("block"), F.col("pane"), 1), change(F.col("block"), F.least(F.col("last") + 1, edge), -1)]
    beyond = [change(F.col("block") + 1, edge, 1), change(F.col("block") + 1, F.col("last") + 1, -1)]
    steps = (
        spans.select("mid", F.inline(F.when(F.col("last") < edge, F.array(*here)).otherwise(F.array(*here, *beyond))))
        .groupBy("mid", "block", "pane")
        .agg(F.sum("users").alias("users"), F.sum("clicks").alias("clicks"))
    )
    along = Window.partitionBy("mid", "block").orderBy("pane")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = steps.select(
        "mid", "pane", F.lead("pane").over(along).alias("until"),
        F.sum("users").over(so_far).alias("uid_count"), F.sum("clicks").over(so_far).alias("clicks"),
    )
    found = counts.where((F.col("uid_count") >= min_users) & (F.col("clicks") == 0)).select(
        "mid", "uid_count", F.explode(F.sequence("pane", F.col("until") - 1)).alias("pane")
    )
    end = (F.col("pane") + 1) * step
    return found.select(
        "mid", F.timestamp_micros(end - length).alias("window_start"), F.timestamp_micros(end).alias("window_end"),
        "uid_count",
    )


def last_per_minute(alerts: DataFrame) -> DataFrame:
    """Of a device's alerts within a minute the last."""
    named = alerts.withColumn("id", minute_id(F.col("mid"), F.col("window_end")))
    return named.groupBy("id", "mid").agg(
        F.max("window_end").alias("window_end"), F.max_by("window_start", "window_end").alias("window_start")
    )


def listed(counts: Column) -> Column:
    """Event kinds with their numbers as a plain list, each kind repeated, kinds in order."""
    return F.flatten(F.transform(F.array_sort(counts), lambda c: F.array_repeat(c["evid"], c["n"].cast("int"))))


def documents(
    events: DataFrame, window: str = K.ALERT_WINDOW, slide: str = K.ALERT_SLIDE, min_users: int = K.ALERT_MIN_USERS
) -> DataFrame:
    """Alert documents (id, mid, uids, itemIds, events, ts), one per device and minute.

    Members are gathered for found alerts only. Event kinds travel as counts and become a list in the document.
    """
    return documents_of(last_per_minute(detect(events, window, slide, min_users)), events, slide)


def documents_of(alerts: DataFrame, events: DataFrame, slide: str) -> DataFrame:
    """The documents of found alerts (id, mid, window_start, window_end), with their members from ``events``."""
    step = F.expr(f"interval {slide}")
    panes = alerts.withColumn(
        "pane_start", F.explode(F.sequence("window_start", F.col("window_end") - step, step))
    )
    pane_start = F.window(F.col("ts").cast("timestamp"), slide)["start"]
    members = events.select("mid", "evid", "uid", "itemid", pane_start.alias("pane_start"))
    joined = members.join(panes, ["mid", "pane_start"])
    per_kind = joined.groupBy("id", "mid", "window_end", "evid").agg(
        F.count("*").alias("n"),
        F.collect_set(F.when(is_coupon(), F.col("uid"))).alias("uids"),
        F.collect_set(F.when(is_coupon(), F.col("itemid"))).alias("items"),
    )
    docs = per_kind.groupBy("id", "mid", "window_end").agg(
        F.max(F.when(is_coupon(), F.sort_array("uids"))).alias("uids"),
        F.max(F.when(is_coupon(), F.sort_array("items"))).alias("itemIds"),
        listed(F.collect_list(F.struct("evid", "n"))).alias("events"),
    )
    return docs.select(
        "id", "mid", "uids", "itemIds", "events", F.unix_millis(F.col("window_end").cast("timestamp")).alias("ts")
    )
