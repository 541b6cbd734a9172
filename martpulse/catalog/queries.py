"""One function per registered query: (spark, folder) to DataFrame.

Lists are given as joined text, times as text and money with two digits, so that both engines compare alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martpulse import constants as K
from martpulse import schemas
from martpulse.catalog import replays
from martpulse.functions.times import date_text, from_millis, hour_text
from martpulse.operators import facets
from martpulse.operators.hours import hour_map
from martpulse.operators.keyed import first_per, latest_per
from martpulse.plans import alerts, cards, changes, devices, orders, sales, search
from martpulse.session import work_dir
from martpulse.sources import shop, sinks
from martpulse.sources.feeds import parse, to_feed
from martpulse.streaming import jobs

LOG_DAY = "2024-01-15"
ORDER_DAY = "1998-06-01"
KEYWORD = "red widget"
# The test tables hold 30 days; an hour takes the place of five minutes, 100 days that of 100 seconds.
WINDOW, SLIDE = "1 hour", "10 minutes"
EXPIRY = "100 days"


def money(column: str) -> Column:
    return F.round(column, 2).alias(column)


def stamp(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def joined_text(column: str) -> Column:
    return F.array_join(column, ",").alias(column)


# --- logs ---------------------------------------------------------------------------------------


def startup_feed(spark: SparkSession, folder: str) -> DataFrame:
    logs = shop.startup_log(spark, folder)
    records = logs.select("mid", "uid", "type", F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"))
    return to_feed(records, K.TOPIC_STARTUP, from_millis(F.col("ts")))


def event_feed(spark: SparkSession, folder: str) -> DataFrame:
    events = shop.event_log(spark, folder)
    records = events.select("mid", "uid", "evid", "itemid", F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"))
    return to_feed(records, K.TOPIC_EVENT, from_millis(F.col("ts")))


def q01_parse_startup(spark, folder):
    logs = parse(startup_feed(spark, folder), schemas.STARTUP_LOG, "mid")
    at = from_millis(F.col("ts"))
    return logs.select("mid", "uid", "type", "ts", date_text(at).alias("log_date"), hour_text(at).alias("log_hour"))


def q02_dau_total(spark, folder):
    return devices.daily_total(shop.startup_log(spark, folder))


def q02b_dau_of_day(spark, folder):
    return devices.total(shop.startup_log(spark, folder), LOG_DAY)


def q03_dau_first_login(spark, folder):
    firsts = devices.first_logins(shop.startup_log(spark, folder))
    return firsts.select(
        "mid", "uid", "type", "log_date", "log_hour", "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("first_ts"),
    )


def q04_dau_hours(spark, folder):
    return devices.by_hour(shop.startup_log(spark, folder), LOG_DAY)


def q04b_dau_hour_map(spark, folder):
    series = devices.by_hour(shop.startup_log(spark, folder), LOG_DAY)
    return hour_map(series, "value").select(F.to_json("hours").alias("hours"))


def q05_dau_incremental(spark, folder):
    """24 batches, each held against what those before it have stored."""
    found = replays.unseen_logins(spark, shop.startup_log(spark, folder))
    return found.select("mid", F.col("log_date").cast("string").alias("log_date"), F.col("batch_id").cast("int").alias("batch"), "event_id")


# --- orders -------------------------------------------------------------------------------------


def order_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as the change log delivers them: every value a text."""
    info = shop.order_info(spark, folder)
    records = info.drop("create_date", "create_hour").withColumn("total_amount", F.col("total_amount").cast("string"))
    at = F.col("order_ts").cast("timestamp")
    return records.select(
        F.lit(K.TOPIC_ORDER).alias("topic"),
        F.to_json(F.struct(*[c for c in records.columns if c != "order_ts"])).alias("value"),
        at.alias("timestamp"), F.lit(None).cast("int").alias("pos"),
    )


def detail_feed(spark: SparkSession, folder: str) -> DataFrame:
    details = shop.order_detail(spark, folder).withColumn("order_price", F.col("order_price").cast("string"))
    return details.select(
        F.lit(K.TOPIC_ORDER_DETAIL).alias("topic"),
        F.to_json(F.struct(*[c for c in details.columns if c != "detail_ts"])).alias("value"),
        F.col("detail_ts").cast("timestamp").alias("timestamp"), F.lit(None).cast("int").alias("pos"),
    )


def q06_order_parse_mask(spark, folder):
    parsed = parse(order_feed(spark, folder), schemas.ORDER_INFO, "id")
    return orders.order_rows(parsed).withColumn("total_amount", F.round("total_amount", 2))


def q07_gmv_total(spark, folder):
    return orders.turnover(shop.order_heads(spark, folder), ORDER_DAY).select(money("sum_amount"))


def q07b_gmv_daily(spark, folder):
    return orders.daily_turnover(shop.order_heads(spark, folder)).select("create_date", money("sum_amount"))


def q08_gmv_hours(spark, folder):
    return orders.turnover_by_hour(shop.order_heads(spark, folder), ORDER_DAY).select("hour", money("value"))


def q09_hourly_compare_dau(spark, folder):
    return cards.hourly_compare("dau", shop.startup_log(spark, folder), LOG_DAY)


def q09b_hourly_compare_json(spark, folder):
    return cards.hourly_json("dau", shop.startup_log(spark, folder), LOG_DAY)


def q10_hourly_compare_gmv(spark, folder):
    series = cards.hourly_compare("order_amount", shop.order_heads(spark, folder), ORDER_DAY)
    return series.select("hour", money("yesterday"), money("today"))


# --- alerts -------------------------------------------------------------------------------------


def q11_coupon_alert(spark, folder):
    found = alerts.detect(shop.event_log(spark, folder), WINDOW, SLIDE)
    return found.select("mid", stamp("window_start"), stamp("window_end"), "uid_count")


def q12_alert_docs(spark, folder):
    docs = alerts.documents(shop.event_log(spark, folder), WINDOW, SLIDE)
    return docs.select("id", "mid", joined_text("uids"), joined_text("itemIds"), joined_text("events"), "ts")


def q12b_alert_per_minute(spark, folder):
    """Two windows end in each minute; of alerts in both the later stays."""
    last = alerts.last_per_minute(alerts.detect(shop.event_log(spark, folder), WINDOW, "30 seconds"))
    return last.select("id", "mid", stamp("window_end"))


# --- sales --------------------------------------------------------------------------------------


def sale_table(spark: SparkSession, folder: str) -> DataFrame:
    return sales.sale_detail(
        shop.order_heads(spark, folder), shop.order_detail(spark, folder), shop.user_info(spark, folder), shop.AS_OF
    )


def found_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows for a search: few lines match, so buyers are looked up for those alone."""
    return sales.sale_detail(
        shop.order_heads(spark, folder), shop.order_detail(spark, folder), shop.user_info(spark, folder), shop.AS_OF,
        buyers_first=False,
    )


def q13_sale_detail(spark, folder):
    return sale_table(spark, folder)


def _expiring(spark, folder, early):
    joined = sales.expiring_sales(shop.order_heads(spark, folder), shop.order_detail(spark, folder), EXPIRY, early)
    return joined.select("order_detail_id", "order_id", "order_status", "user_id", "sku_id", "sku_name", "sku_price", "dt")


def q14_sale_detail_expiry(spark, folder):
    return _expiring(spark, folder, "buffer")


def q14b_sale_detail_expiry_forward(spark, folder):
    return _expiring(spark, folder, "drop")


def q15_unmatched_orders(spark, folder):
    alone = sales.unmatched_orders(shop.order_heads(spark, folder), shop.order_detail(spark, folder))
    return alone.select("order_id", "order_status", "dt", "user_id")


def q15b_full_outer(spark, folder):
    both = sales.joined_or_alone(shop.order_heads(spark, folder), shop.order_detail(spark, folder))
    return both.select("order_id", "order_detail_id", "order_status", "sku_price", "status")


# --- search -------------------------------------------------------------------------------------


def q16_sale_search_page(spark, folder):
    found = search.page(found_sales(spark, folder), KEYWORD, page=2, size=20)
    return found.select("order_detail_id", "sku_name", "user_gender", "user_age", "dt", F.round("score", 6).alias("score"))


def q16b_sale_search_one_word(spark, folder):
    found = search.page(found_sales(spark, folder), "Widget", size=100)
    return found.select("order_detail_id", "sku_name", F.round("score", 6).alias("score"))


def q17_sale_search_total(spark, folder):
    lines = sales.sold_lines(shop.order_heads(spark, folder), shop.order_detail(spark, folder))
    return search.total(lines, KEYWORD)


def q17b_sale_search_total_day(spark, folder):
    # The stored order time is filtered as well as the derived day, so that the filter reaches the scan.
    heads = orders.of_days(shop.order_heads(spark, folder), ORDER_DAY)
    return search.total(sales.sold_lines(heads, shop.order_detail(spark, folder)), "widget", ORDER_DAY)


def q17c_stored_search(spark, folder):
    """Sale documents stored by month; the search reads only the month it asks for."""
    path = work_dir(spark, "sales")
    docs = sale_table(spark, folder)
    sinks.save_partitioned(docs.withColumn("month", F.substring("dt", 1, 7)), path, "month")
    stored = spark.read.schema(f"{schemas.SALE_DETAIL}, month STRING").parquet(path)
    return facets.totals(search.hits(stored.where(F.col("month") == ORDER_DAY[:7]), "widget"))


def _hits(spark, folder):
    return search.hits(found_sales(spark, folder), KEYWORD)


def q18_terms_gender(spark, folder):
    return facets.terms(_hits(spark, folder), "user_gender")


def q19_terms_age_top10(spark, folder):
    return facets.terms(_hits(spark, folder), "user_age", limit=10)


def q20_gender_share(spark, folder):
    return facets.gender_share(_hits(spark, folder))


def q21_age_share(spark, folder):
    return facets.age_share(_hits(spark, folder))


def q21b_search_response(spark, folder):
    return search.response(found_sales(spark, folder), KEYWORD, size=10)


# --- cards --------------------------------------------------------------------------------------


def q22_kpi_cards(spark, folder):
    rows = cards.kpi_totals(
        shop.startup_log(spark, folder), shop.order_heads(spark, folder), LOG_DAY, order_date=ORDER_DAY
    )
    return rows.select("id", "name", money("value"))


def q22b_new_devices(spark, folder):
    return devices.new_devices(shop.startup_log(spark, folder))


# --- changes, users, documents ------------------------------------------------------------------


def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    return changes.flattened(changes.routed(shop.change_log(spark, folder)))


def q23_cdc_route(spark, folder):
    entries = changes.routed(shop.change_log(spark, folder))
    return entries.groupBy("topic", "table_name", "event_type").agg(
        F.count("*").alias("entries"), F.sum(F.size("rows")).alias("row_count")
    )


def q24_cdc_flatten(spark, folder):
    return change_feed(spark, folder).select("topic", "value", "pos")


def q25_user_latest(spark, folder):
    feed = change_feed(spark, folder).where(F.col("topic") == K.TOPIC_USER)
    users = parse(feed, schemas.USER_INFO, "id", keep=("timestamp", "pos"))
    newest = latest_per(users, ["id"], ["timestamp", "pos"])
    return newest.select("id", "login_name", "user_level", F.col("birthday").cast("string").alias("birthday"), "gender")


def q26_upsert_docs(spark, folder):
    """All sales as documents, then those of finished orders again with a new status."""
    path = work_dir(spark, "documents")
    sinks.write_batch(sale_table(spark, folder), 0, path)
    docs = sinks.read_all(spark, path, schemas.SALE_DETAIL).drop("run", "batch_id")
    sinks.write_batch(docs.where("order_status = 'F'").withColumn("order_status", F.lit("DONE")), 1, path)
    newest = sinks.read_latest(spark, path, schemas.SALE_DETAIL, ["order_detail_id"], columns=["order_status", "sku_price"])
    return newest.select("order_detail_id", "order_status", "sku_price")


def q27_regional_sales(spark, folder):
    sold = orders.regional_sales(shop.order_info(spark, folder), shop.provinces(spark, folder))
    return sold.select("province_id", "name", "order_count", money("value"))


def q28_regional_bands(spark, folder):
    return orders.regional_bands(shop.order_info(spark, folder), shop.provinces(spark, folder))


def q29_multi_day_read(spark, folder):
    """First logins stored by day; a week of days read back."""
    path = work_dir(spark, "first-logins")
    sinks.save_partitioned(devices.first_logins(shop.startup_log(spark, folder)), path, "log_date")
    stored = spark.read.option("basePath", path).parquet(path)
    week = stored.where(F.col("log_date").between("2024-01-10", "2024-01-16"))
    days = week.groupBy(F.col("log_date").cast("string").alias("log_date"))
    return days.agg(F.count("*").alias("dau"))


# --- streams ------------------------------------------------------------------------------------


def q30_stream_dau(spark, folder):
    rows, _ = replays.first_logins(spark, startup_feed(spark, folder))
    return rows.select("mid", "uid", "log_date", "log_hour")


def q31_stream_alert(spark, folder):
    docs, _ = replays.alert_documents(spark, event_feed(spark, folder), WINDOW, SLIDE)
    return docs.select("id", "mid", joined_text("uids"), joined_text("itemIds"), joined_text("events"), "ts")


def user_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Users as the change log delivers them."""
    records = shop.user_info(spark, folder)
    texts = F.struct(*[F.col(c).cast("string").alias(c) for c in records.columns])
    return records.select(
        F.lit(K.TOPIC_USER).alias("topic"), F.to_json(texts).alias("value"),
        F.lit("1990-01-01").cast("timestamp").alias("timestamp"), F.lit(0).alias("pos"),
    )


def sale_run(spark: SparkSession, folder: str) -> str:
    """The table of sale documents that the users', orders' and lines' feeds lead to."""
    table, _ = replays.sale_documents(
        spark, order_feed(spark, folder), detail_feed(spark, folder), user_feed(spark, folder), EXPIRY, shop.AS_OF
    )
    return table


def q32_stream_sale_detail(spark, folder):
    return jobs.stored_sales(spark, sale_run(spark, folder)).select(*schemas.SALE_DETAIL_COLUMNS)


def q33_stream_orders(spark, folder):
    rows, _ = replays.order_rows(spark, order_feed(spark, folder))
    return orders.daily_turnover(rows).select("create_date", money("sum_amount"))


def q34_stream_users(spark, folder):
    users, _ = replays.users(spark, change_feed(spark, folder).where(F.col("topic") == K.TOPIC_USER))
    return users.select("id", "login_name", "user_level", F.col("birthday").cast("string").alias("birthday"), "gender")


def q35_stream_changes(spark, folder):
    rows, _ = replays.change_rows(spark, shop.change_log(spark, folder))
    return rows.select("topic", "value")


# --- the dashboard's questions to the tables that the jobs write ------------------------------------


def q36_served_turnover(spark, folder):
    rows, _ = replays.order_rows(spark, order_feed(spark, folder))
    return orders.turnover(rows, ORDER_DAY).select(money("sum_amount"))


def q36b_served_turnover_hours(spark, folder):
    rows, _ = replays.order_rows(spark, order_feed(spark, folder))
    return cards.hourly_compare("order_amount", rows, ORDER_DAY).select("hour", money("yesterday"), money("today"))


def q37_served_search(spark, folder):
    stored = jobs.stored_sales(spark, sale_run(spark, folder), ["sku_name"], ORDER_DAY)
    return search.total(stored, "widget", ORDER_DAY)


def q38_served_devices(spark, folder):
    rows, _ = replays.first_logins(spark, startup_feed(spark, folder))
    return devices.stored_total(rows, LOG_DAY)


def q38b_served_device_hours(spark, folder):
    rows, _ = replays.first_logins(spark, startup_feed(spark, folder))
    return cards.hourly_compare("dau", rows, LOG_DAY)


def q39_new_devices_from_table(spark, folder):
    """Active and new devices of a day, from one day of logs and the first-seen table."""
    path = work_dir(spark, "first-seen")
    logs = shop.startup_log(spark, folder)
    devices.first_seen(logs).write.parquet(path)
    return devices.day_counts_from(logs, spark.read.parquet(path), LOG_DAY)


def q40_kpi_json(spark, folder):
    return cards.kpi_json(shop.startup_log(spark, folder), shop.order_heads(spark, folder), LOG_DAY, order_date=ORDER_DAY)


# --- rows that come late, wait in vain or come again ---------------------------------------------------


def delayed(feed: DataFrame, most_hours: int) -> DataFrame:
    """The feed as it arrives when every message is held up by its own number of minutes."""
    minutes = F.pmod(F.xxhash64("value"), F.lit(most_hours * 60)).cast("int")
    return feed.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(mins=minutes))


def q41_stream_dau_late(spark, folder):
    """Logs up to four days late, over days that have been closed."""
    rows, _ = replays.late_logins(spark, delayed(startup_feed(spark, folder), 96))
    firsts = first_per(rows, ["mid", "log_date"], ["ts", "uid"])
    return firsts.select("mid", "uid", "log_date", "log_hour")


def q41b_stream_alert_late(spark, folder):
    """Events up to two hours late, over windows that have been closed."""
    docs, _ = replays.alert_documents(spark, delayed(event_feed(spark, folder), 2), WINDOW, SLIDE)
    return docs.select("id", "mid", joined_text("uids"), joined_text("itemIds"), joined_text("events"), "ts")


def q42_stream_unmatched(spark, folder):
    rows, _ = replays.unmatched(spark, order_feed(spark, folder), detail_feed(spark, folder), EXPIRY)
    return rows.select("order_id", "order_detail_id", stamp("seen_at"), "status")


def q43_cards_from_tables(spark, folder):
    """The totals panel from the tables that the jobs keep, without history."""
    table, seen, _ = replays.first_seen(spark, startup_feed(spark, folder))
    new = jobs.first_seen_on(spark, seen, F.lit(LOG_DAY))
    stored, _ = replays.order_rows(spark, order_feed(spark, folder))
    return cards.kpi_stored(table, new, stored, LOG_DAY, ORDER_DAY).select("id", "name", money("value"))


def q44_indexed_search(spark, folder):
    """A search that reads its words' part of the index, over the sales that the job has stored."""
    table = sale_run(spark, folder)
    found = jobs.indexed_sales(spark, table, f"{table}-words", KEYWORD)
    scored = search.next_page(found, KEYWORD, size=100)
    return scored.select("order_detail_id", "sku_name", "dt", F.round("score", 6).alias("score"))


def q46_search_walk(spark, folder):
    """The third page of a search, reached from page to page by score and id."""
    after = None
    for _ in range(3):
        found = search.next_page(found_sales(spark, folder), "widget", after=after, size=40)
        rows = found.select("score", "order_detail_id").collect()  # one page
        after = (rows[-1].score, rows[-1].order_detail_id) if rows else after
    return found.select("order_detail_id", "sku_name", F.round("score", 6).alias("score"))


def q45_backfilled_orders(spark, folder):
    """Orders whose status and amount of a week later are known already when an old feed is gone over again."""
    feed = order_feed(spark, folder)
    amount = F.get_json_object("value", "$.total_amount").cast("double")
    newer = feed.withColumn("timestamp", F.col("timestamp") + F.expr("interval 7 days")).withColumn(
        "value", F.regexp_replace("value", F.lit('"total_amount":"[^"]*"'), F.concat(F.lit('"total_amount":"'), (amount + 1).cast("string"), F.lit('"')))
    )
    rows = replays.backfilled_orders(spark, newer, feed)
    return orders.daily_turnover(rows).select("create_date", money("sum_amount"))


ALL = {
    name: function
    for name, function in sorted(globals().items())
    if name.startswith("q") and name[1:3].isdigit()
}
