"""What Spark makes of the queries: pruned scans, pushed filters, no Python, no cross joins, split hot keys."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from martpulse.catalog import queries as Q
from martpulse.operators.joins import replicated, salted
from martpulse.plans import alerts, cards, devices, orders, sales, search
from martpulse.sources import shop

TABLE_QUERIES = [n for n in Q.ALL if "stream" not in n and n not in ("q17c_stored_search", "q26_upsert_docs", "q29_multi_day_read")]


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", TABLE_QUERIES)
def test_no_python_no_cross_join(spark, folder, name):
    text = plan(Q.ALL[name](spark, folder))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def read_columns(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", text)]


def test_daily_devices_read_two_columns_and_push_the_day(spark, folder):
    text = plan(devices.by_hour(shop.startup_log(spark, folder), "2024-01-15"))
    assert read_columns(text) == [{"ts", "user_id"}]
    assert "GreaterThanOrEqual(ts,2024-01-15" in text and "LessThan(ts,2024-01-16" in text


def test_turnover_reads_two_columns_and_pushes_the_day(spark, folder):
    text = plan(orders.turnover(shop.order_heads(spark, folder), "1998-06-01"))
    assert read_columns(text) == [{"o_totalprice", "o_orderdate"}]
    assert "GreaterThanOrEqual(o_orderdate,1998-06-01" in text
    assert "Join" not in text


def test_cards_scan_each_table_once(spark, folder):
    text = plan(cards.kpi_totals(shop.startup_log(spark, folder), shop.order_heads(spark, folder), "2024-01-15"))
    assert text.count("Scan parquet") / 2 == 2


def test_search_filters_goods_before_the_join(spark, folder):
    text = plan(Q.q17_sale_search_total(spark, folder), "simple")
    goods = next(part for part in text.split("FileScan") if "part.parquet" in part)
    assert "p_name" in goods
    above = text[: text.index("part.parquet")].splitlines()
    assert any("Filter" in row and "red" in row for row in above[-3:])


def test_alert_detection_does_not_copy_rows_or_collect(spark, folder):
    text = plan(alerts.detect(shop.event_log(spark, folder)))
    assert "Expand" not in text and "collect_" not in text


def test_one_device_is_spread_over_days(spark, small_limits):
    days = spark.range(30 * 1440).select(
        F.lit("hot").alias("mid"), F.concat(F.lit("u"), F.col("id") % 5).alias("uid"), F.lit("coupon").alias("evid"),
        F.lit("i").alias("itemid"), F.timestamp_seconds(F.col("id") * 60).alias("ts"),
    )
    found = alerts.detect(days)
    text = plan(found, "simple")
    windows = [row for row in text.splitlines() if "Window " in row or "Window(" in row]
    assert windows and all("block" in row for row in windows)
    tasks = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) > 1 and max(t["count"] for t in tasks) < 0.8 * sum(t["count"] for t in tasks)
    assert found.where("uid_count >= 5").count() == 30 * 1440 - 4


def test_page_is_a_top_k(spark, folder):
    assert "TakeOrderedAndProject" in plan(Q.q16_sale_search_page(spark, folder))


@pytest.fixture
def small_limits(spark):
    """Sizes scaled down so that a few thousand rows count as a big, skewed table."""
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed(spark, tmp_path):
    """Orders, of which one has a third of all lines; stored in several files, as a big table would be."""
    n = 60_000
    lines = spark.range(0, n, 1, 16).select(
        F.concat(F.lit("d"), "id").alias("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5000).cast("string")).alias("order_id"),
        F.lit("s").alias("sku_id"), F.sha2(F.col("id").cast("string"), 256).alias("sku_name"),
        F.lit("1.5").alias("order_price"), F.timestamp_seconds(F.lit(0)).alias("detail_ts"),
    )
    heads = spark.range(5001).select(
        F.when(F.col("id") == 5000, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("1").alias("order_status"), F.lit("2024-01-01 10:00:00").alias("create_time"),
        F.lit("2024-01-01").alias("create_date"), F.lit("u").alias("user_id"),
        F.timestamp_seconds(F.lit(0)).alias("order_ts"),
    )
    lines.write.parquet(str(tmp_path / "lines"))
    heads.write.parquet(str(tmp_path / "heads"))
    return spark.read.parquet(str(tmp_path / "heads")), spark.read.parquet(str(tmp_path / "lines")), n


def test_hot_order_is_split_in_inner_and_outer_joins(spark, tmp_path, small_limits):
    heads, lines, n = skewed(spark, tmp_path)
    for joined, rows in (
        (sales.expiring_sales(heads, lines, "100 seconds"), n),
        (sales.joined_or_alone(heads, lines), n),
    ):
        got = joined.collect()
        assert len(got) == rows
        assert "isSkewJoin=true" in joined._jdf.queryExecution().executedPlan().toString() or (
            "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        )


def test_salting_spreads_a_key_evenly_and_stably(spark):
    rows = spark.range(8000).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("id"))
    spread = salted(rows, F.col("id"), 8)
    counts = [r["count"] for r in spread.groupBy("_salt").count().collect()]
    assert len(counts) == 8 and max(counts) < 1.2 * min(counts)
    assert spread.exceptAll(salted(rows.repartition(7), F.col("id"), 8)).count() == 0
    one = replicated(spark.range(1), 8)
    assert one.count() == 8


def test_each_shuffle_of_daily_devices_follows_a_partial_aggregate(spark, folder):
    text = plan(devices.daily_total(shop.startup_log(spark, folder)), "simple")
    lines = [row for row in text.splitlines() if "Exchange" in row or "HashAggregate" in row]
    assert [("Exchange" in row) for row in lines].count(True) == 2
    for i, row in enumerate(lines):
        if "Exchange" in row:
            assert "HashAggregate" in lines[i + 1]


def test_stored_documents_are_pruned_by_partition(spark, folder):
    text = plan(Q.q17c_stored_search(spark, folder))
    assert re.search(r"PartitionFilters: \[isnotnull\(month#\d+\), \(month#\d+ = 1998-06\)\]", text)
    assert read_columns(text) == [{"user_gender", "user_age", "sku_name"}]


def test_streams_fold_before_their_shuffles(spark, tmp_path):
    from martpulse.schemas import EVENT_LOG, FEED
    from martpulse.sources.feeds import file_feed
    from martpulse.streaming import jobs

    spark.createDataFrame([], FEED).write.parquet(str(tmp_path / "feed"))
    feed = file_feed(spark, str(tmp_path / "feed"))
    for rows in (jobs.new_logins(feed), jobs.live_alerts(jobs.parsed_logs(feed, EVENT_LOG))):
        lines = [r for r in plan(rows, "simple").splitlines() if "Exchange" in r or "Aggregate" in r]
        shuffles = [i for i, row in enumerate(lines) if "Exchange" in row]
        folds = ("partial_", "functions=[]")  # the latter leaves distinct keys only
        assert shuffles and all("Aggregate" in lines[i + 1] and any(f in lines[i + 1] for f in folds) for i in shuffles)


def test_an_answer_reads_each_table_once(spark, folder):
    rows, totals = search.observed_page(Q.found_sales(spark, folder), Q.KEYWORD, size=10)
    assert len(re.findall(r"\(\d+\) Scan parquet", plan(rows))) == 4
    assert len(rows.collect()) == 10 and totals.get["total"] > 10


def test_a_walk_gives_the_numbered_pages_without_gathering_them(spark, folder):
    sold = Q.found_sales(spark, folder).where("order_id < '2'").persist()
    after, walked = None, []
    while rows := search.next_page(sold, "widget", after=after, size=400).collect():
        walked += [r.order_detail_id for r in rows]
        after = (rows[-1].score, rows[-1].order_detail_id)
    numbered = [r.order_detail_id for n in range(1, len(walked) // 400 + 2) for r in search.page(sold, "widget", page=n, size=400).collect()]
    assert walked == numbered and len(walked) > 400
    text = plan(search.next_page(sold, "widget", after=(0.25, "5"), size=30), "simple")
    assert re.search(r"TakeOrderedAndProject\(limit=30,", text) and "offset" not in text.lower()
    sold.unpersist()


def test_cards_read_a_day_of_devices_and_its_slice_of_new_ones(spark, folder):
    text = plan(Q.q43_cards_from_tables(spark, folder))
    filters = [" ".join(re.findall("PartitionFilters.*", s)) for s in re.findall(r"\(\d+\) Scan parquet.*?ReadSchema", text, re.S)]
    assert len(filters) == 3 and sum("log_date" in f for f in filters) == 1
    assert sum("first_date" in f for f in filters) == 1 and sum("create_period" in f for f in filters) == 1
