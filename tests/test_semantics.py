"""Hand-made rows for each point where a choice was made."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from martpulse import schemas
from martpulse.functions.numbers import colour_band, percent, rest
from martpulse.functions.texts import has_all_words, mask_tel, relevance, words
from martpulse.functions.times import age_years, text_date, text_hour
from martpulse.operators import facets
from martpulse.operators.joins import full_outer
from martpulse.operators.keyed import first_per, latest_per, unseen
from martpulse.operators.paging import page_of
from martpulse.plans import alerts, cards, changes, devices, orders, sales, search
from martpulse.sources import sinks
from martpulse.sources.feeds import broker_options, changes_of, parse, rejected


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def feed(spark, *values):
    rows = [("t", v if isinstance(v, (str, type(None))) else json.dumps(v), dt.datetime(2024, 1, 1), None) for v in values]
    return spark.createDataFrame(rows, schemas.FEED)


def logs(spark, rows):
    data = [(m, u, dt.datetime.fromisoformat(t), i) for i, (m, u, t) in enumerate(rows)]
    return spark.createDataFrame(data, "mid STRING, uid STRING, ts TIMESTAMP, event_id BIGINT")


# --- functions ----------------------------------------------------------------------------------


def test_mask_keeps_four_and_survives_short_numbers(spark):
    assert one(spark, mask_tel(F.lit("13812345678")), mask_tel(F.lit("13")), mask_tel(F.lit(None).cast("string"))) == (
        "1381*********", "13*********", None)


def test_create_time_parts(spark):
    text = F.lit("2021-02-22 14:18:09")
    assert one(spark, text_date(text), text_hour(text), text_hour(F.lit("2021-02-22"))) == ("2021-02-22", "14", "")


def test_age_is_cut_to_365_day_years(spark):
    as_of = F.lit("2024-01-01").cast("date")
    ages = [age_years(F.lit(d).cast("date"), as_of) for d in ("2004-01-06", "2004-01-05", "2024-06-01", "2025-06-01")]
    assert one(spark, *ages) == (20, 20, 0, -1)
    assert one(spark, age_years(F.lit("2004-01-07").cast("date"), as_of)) == (19,)


def test_percent_rounds_halves_up_and_is_zero_for_nothing(spark):
    def pct(n, total):
        return percent(F.lit(n), F.lit(total))

    assert one(spark, pct(591, 1169), pct(1, 2000), pct(1, 3), pct(0, 0)) == (50.6, 0.1, 33.3, 0.0)
    assert one(spark, rest(F.lit(10.2), F.lit(70.5)), rest(pct(0, 0))) == (19.3, 100.0)


def test_colour_bands(spark):
    assert one(spark, *[colour_band(F.lit(v)) for v in (0, 99, 100, 599, 600, 10**6)]) == (0, 0, 1, 5, 5, 5)


def test_words(spark):
    got = one(spark, words(F.lit("Red-Widget 2.5kg")), words(F.lit("小米Phone 10")), words(F.lit(" -- ")))
    assert got == (["red", "widget", "2.5kg"], ["小", "米", "phone", "10"], [])


@pytest.mark.parametrize(
    "text, keyword, hit",
    [
        ("red widget", "RED", True), ("red widget", "widget red", True), ("red widget", "red ring", False),
        ("redder widget", "red", False), ("red widget", "", False), ("red widget", "--", False),
        ("小米手机", "手机", True), ("小米手机", "华为", False), (None, "red", None), ("red-widget", "red-widget", True),
    ],
)
def test_keyword_match(spark, text, keyword, hit):
    got = one(spark, has_all_words(F.lit(text).cast("string"), keyword))[0]
    assert got == hit or (hit is None and not got)


def test_relevance_counts_each_keyword_word_once(spark):
    assert one(spark, relevance(F.lit("red red widget"), "red red"), relevance(F.lit(""), "red")) == (2 / 3, 0.0)


# --- feeds --------------------------------------------------------------------------------------


def test_text_numbers_are_cast_and_bad_ones_are_null(spark):
    rows = parse(feed(spark, {"id": "1", "total_amount": "12.5"}, {"id": "2", "total_amount": 7},
                      {"id": "3", "total_amount": "x"}), schemas.ORDER_INFO, "id")
    assert [(r.id, r.total_amount) for r in rows.orderBy("id").collect()] == [("1", 12.5), ("2", 7.0), ("3", None)]


def test_malformed_messages_are_set_aside(spark):
    messages = feed(spark, {"id": "1"}, "{broken", "[1]", None, {"other": 1}, "")
    assert [r.id for r in parse(messages, schemas.USER_INFO, "id").collect()] == ["1"]
    assert rejected(messages, schemas.USER_INFO, "id").count() == 5


def test_malformed_birthday_is_null(spark):
    rows = parse(feed(spark, {"id": "1", "birthday": "2000-02-30"}, {"id": "2", "birthday": "2000-02-29"}),
                 schemas.USER_INFO, "id").orderBy("id").collect()
    assert [r.birthday for r in rows] == [None, dt.date(2000, 2, 29)]


def test_order_rows_have_all_columns_in_order(spark):
    order = {"id": "1", "create_time": "2021-02-22 14:18:09", "consignee_tel": "13812345678", "total_amount": "1"}
    row = orders.order_rows(parse(feed(spark, order), schemas.ORDER_INFO, "id"))
    assert len(row.columns) == 20 and row.columns[-2:] == ["create_date", "create_hour"]
    assert tuple(row.select("create_date", "create_hour", "consignee_tel").first()) == (
        "2021-02-22", "14", "1381*********")


def test_broker_options():
    assert broker_options("h:1", "order", max_offsets=5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "order", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5"}


def entries(spark, rows):
    data = [
        (kind, table, event, dt.datetime(2024, 1, 1), [[(k, v) for k, v in image.items()] for image in images])
        for kind, table, event, images in rows
    ]
    return spark.createDataFrame(data, schemas.CHANGE_ENTRY)


def test_changes_are_routed_and_flattened(spark):
    log = entries(spark, [
        ("ROWDATA", "order_info", "INSERT", [{"id": "1", "total_amount": "9.5"}, {"id": "2", "total_amount": ""}]),
        ("ROWDATA", "order_info", "UPDATE", [{"id": "3"}]),
        ("ROWDATA", "order_detail", "INSERT", [{"id": "4"}]),
        ("ROWDATA", "order_detail", "DELETE", [{"id": "5"}]),
        ("ROWDATA", "user_info", "INSERT", [{"id": "6"}]),
        ("ROWDATA", "user_info", "UPDATE", [{"id": "7"}]),
        ("ROWDATA", "user_info", "DELETE", [{"id": "8"}]),
        ("TRANSACTIONEND", "user_info", "INSERT", [{"id": "9"}]),
        ("ROWDATA", "sku_info", "INSERT", [{"id": "10"}]),
        ("ROWDATA", "order_info", "INSERT", []),
    ])
    rows = changes.flattened(changes.routed(log)).collect()
    assert sorted((r.topic, r.value) for r in rows) == [
        ("order", '{"id":"1","total_amount":"9.5"}'), ("order", '{"id":"2","total_amount":""}'),
        ("order_detail", '{"id":"4"}'), ("user_info", '{"id":"6"}'), ("user_info", '{"id":"7"}')]


# --- devices ------------------------------------------------------------------------------------


def test_first_login_is_per_device_and_its_own_day(spark):
    rows = logs(spark, [("a", "u1", "2024-01-02 09:00:00"), ("a", "u2", "2024-01-02 08:00:00"),
                        ("a", "u3", "2024-01-01 23:59:59"), ("b", "u4", "2024-01-02 10:00:00")])
    got = {(r.mid, r.log_date): (r.uid, r.log_hour) for r in devices.first_logins(rows).collect()}
    assert got == {("a", "2024-01-02"): ("u2", "08"), ("a", "2024-01-01"): ("u3", "23"),
                   ("b", "2024-01-02"): ("u4", "10")}
    assert devices.total(rows, "2024-01-02").first().dau == 2
    assert devices.total(rows, "2030-01-01").first().dau == 0
    assert tuple(devices.day_counts(rows, "2024-01-02").first()) == (2, 1)


def test_today_is_the_default_day(spark):
    rows = spark.range(3).select(F.col("id").cast("string").alias("mid"), F.current_timestamp().alias("ts"))
    assert devices.total(rows).first().dau == 3


def test_unseen_keeps_new_keys_only(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "mid STRING, n INT")
    seen = spark.createDataFrame([("a",), ("a",)], "mid STRING")
    assert {r.mid for r in unseen(batch, seen, ["mid"]).collect()} == {"b", None}


def test_first_and_latest_whole_rows(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 3, None)], "k STRING, t INT, v STRING")
    assert tuple(first_per(rows, ["k"], ["t"]).first()) == ("a", 1, "y")
    assert tuple(latest_per(rows, ["k"], ["t"]).first()) == ("a", 3, None)


# --- turnover and cards -------------------------------------------------------------------------


def amounts(spark, rows):
    return spark.createDataFrame(rows, "create_date STRING, create_hour STRING, total_amount DOUBLE")


def test_turnover_of_an_empty_day_is_null(spark):
    rows = amounts(spark, [("2024-01-02", "08", 0.1), ("2024-01-02", "08", 0.2), ("2024-01-01", "07", 5.0)])
    assert orders.turnover(rows, "2024-01-03").first().sum_amount is None
    assert orders.turnover(rows, "2024-01-02").first().sum_amount == 0.3


def test_hours_are_filled_and_compared(spark):
    rows = amounts(spark, [("2024-03-01", "08", 2.5), ("2024-02-29", "23", 1.0), ("2024-02-28", "08", 9.0)])
    got = {r.hour: (r.yesterday, r.today) for r in cards.hourly_compare("order_amount", rows, "2024-03-01").collect()}
    assert len(got) == 24 and sorted(got)[0] == "00" and sorted(got)[-1] == "23"
    assert got["08"] == (0.0, 2.5) and got["23"] == (1.0, 0.0) and got["12"] == (0.0, 0.0)
    answer = json.loads(cards.hourly_json("order_amount", rows, "2024-03-01").first().response)
    assert answer == {"yesterday": {"23": 1.0}, "today": {"08": 2.5}}
    with pytest.raises(ValueError):
        cards.hourly_compare("other", rows)


def test_cards_as_json(spark):
    seen = logs(spark, [("a", "u", "2024-01-01 01:00:00"), ("a", "u", "2024-01-02 01:00:00"),
                        ("b", "u", "2024-01-02 01:00:00")])
    rows = amounts(spark, [("2024-01-02", "01", 3.5)])
    assert json.loads(cards.kpi_json(seen, rows, "2024-01-02").first().response) == [
        {"id": "dau", "name": "新增日活", "value": 2.0}, {"id": "new_mid", "name": "新增设备", "value": 1.0},
        {"id": "order_amount", "name": "新增交易额", "value": 3.5}]


# --- sales --------------------------------------------------------------------------------------


def sale_inputs(spark):
    heads = spark.createDataFrame(
        [("1", "1001", "2024-01-01 10:00:00", "2024-01-01", "u1", dt.datetime(2024, 1, 1, 10, 0, 0)),
         ("2", "1001", "2024-01-01 10:00:00", "2024-01-01", "nobody", dt.datetime(2024, 1, 1, 10, 0, 0)),
         ("3", "1001", "2024-01-01 10:00:00", "2024-01-01", None, dt.datetime(2024, 1, 1, 10, 0, 0))],
        "id STRING, order_status STRING, create_time STRING, create_date STRING, user_id STRING, order_ts TIMESTAMP")
    lines = spark.createDataFrame(
        [("d1", "1", "s", "red ring", "9.5", dt.datetime(2024, 1, 1, 10, 1, 40)),
         ("d2", "1", "s", "red ring", "bad", dt.datetime(2024, 1, 1, 9, 58, 20)),
         ("d3", "2", "s", "red ring", "1", dt.datetime(2024, 1, 1, 10, 1, 41)),
         ("d4", "9", "s", "red ring", "1", dt.datetime(2024, 1, 1, 10, 0, 0))],
        "id STRING, order_id STRING, sku_id STRING, sku_name STRING, order_price STRING, detail_ts TIMESTAMP")
    users = spark.createDataFrame([("u1", "M", dt.date(2000, 1, 1), "2")],
                                  "id STRING, gender STRING, birthday DATE, user_level STRING")
    return heads, lines, users


def test_buyer_may_be_unknown(spark):
    heads, lines, users = sale_inputs(spark)
    rows = {r.order_detail_id: r for r in sales.sale_detail(heads, lines, users, "2024-01-01").collect()}
    assert set(rows) == {"d1", "d2", "d3"}
    assert (rows["d1"].user_age, rows["d1"].user_gender, rows["d1"].sku_price) == (24, "M", 9.5)
    assert rows["d2"].sku_price is None
    assert (rows["d3"].user_id, rows["d3"].user_age, rows["d3"].user_gender) == ("nobody", 0, None)


def test_expiry_is_inclusive_and_early_lines_are_a_choice(spark):
    heads, lines, _ = sale_inputs(spark)
    both = sales.expiring_sales(heads, lines, "100 seconds")
    assert {r.order_detail_id for r in both.collect()} == {"d1", "d2"}
    late_only = sales.expiring_sales(heads, lines, "100 seconds", "drop")
    assert {r.order_detail_id for r in late_only.collect()} == {"d1"}
    with pytest.raises(ValueError):
        sales.expiring_sales(heads, lines, "100 seconds", "other")


def test_full_outer_shows_both_lonely_sides(spark):
    heads, lines, _ = sale_inputs(spark)
    rows = {(r.order_id, r.order_detail_id): r.status for r in sales.joined_or_alone(heads, lines).collect()}
    assert rows == {("1", "d1"): "matched", ("1", "d2"): "matched", ("2", "d3"): "matched", ("9", "d4"): "detail_only",
                    ("3", None): "order_only"}
    assert {r.order_id for r in sales.unmatched_orders(heads, lines).collect()} == {"3"}


def test_full_outer_equals_sparks_own_with_null_keys(spark):
    many = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k STRING, m INT")
    single = spark.createDataFrame([("a", 10), ("c", 11), (None, 12)], "k STRING, o INT")
    ours, theirs = full_outer(many, single, "k"), many.join(single, "k", "full_outer")
    assert sorted(map(str, ours.select("k", "m", "o").collect())) == sorted(map(str, theirs.collect()))


def sale_docs(spark, people):
    rows = [(f"d{i}", "red ring" if i % 2 else "red red widget", g, a, "2024-01-01") for i, (g, a) in enumerate(people)]
    docs = spark.createDataFrame(
        rows, "order_detail_id STRING, sku_name STRING, user_gender STRING, user_age INT, dt STRING")
    for name in schemas.SALE_DETAIL_COLUMNS:
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast("double" if name == "sku_price" else "string"))
    return docs


def shares(df):
    return {r.name: r.value for r in df.collect()}


def test_shares(spark):
    docs = sale_docs(spark, [("M", 19), ("F", 20), (None, 29), ("X", 30), ("M", None), ("M", 59)])
    found = search.hits(docs, "red")
    assert shares(facets.gender_share(found)) == {"男": 50.0, "女": 50.0}
    assert shares(facets.age_share(found)) == {"20岁以下": 16.7, "20岁到30岁": 50.0, "30岁及30岁以上": 33.3}
    assert {r.key: r.doc_count for r in facets.terms(found, "user_gender").collect()} == {"M": 3, "F": 1, "X": 1}


def test_search_without_hits(spark):
    docs = sale_docs(spark, [("M", 19)])
    for keyword in ("ring blue", ""):
        answer = json.loads(search.response(docs, keyword, "2024-01-01").first().response)
        assert answer["total"] == 0 and answer["detail"] == []
        values = {o["name"]: o["value"] for s in answer["stat"] for o in s["options"]}
        assert values == {"男": 0.0, "女": 100.0, "20岁以下": 0.0, "20岁到30岁": 100.0, "30岁及30岁以上": 0.0}
    assert search.total(docs, "red", "2024-01-02").first().total == 0


def test_pages_cover_all_hits_once_best_first(spark):
    docs = sale_docs(spark, [("M", 30)] * 7)
    seen = [r.order_detail_id for n in (1, 2, 3, 4) for r in search.page(docs, "red", page=n, size=3).collect()]
    assert seen == ["d0", "d2", "d4", "d6", "d1", "d3", "d5"]
    with pytest.raises(ValueError):
        page_of(docs, [F.col("dt")], 0, 5)


# --- alerts -------------------------------------------------------------------------------------


def events(spark, rows):
    data = [(m, u, e, i, dt.datetime.fromisoformat(f"2024-01-01 {t}")) for m, u, e, i, t in rows]
    return spark.createDataFrame(data, "mid STRING, uid STRING, evid STRING, itemid STRING, ts TIMESTAMP")


COUPONS = [("m", "u1", "coupon", "i1", "00:00:30"), ("m", "u2", "coupon", "i2", "00:01:30"),
           ("m", "u2", "coupon", "i3", "00:01:40"), ("m", "u1", "addCart", "i9", "00:02:10"),
           ("m", "u3", "coupon", "i1", "00:02:30")]


def ends(df):
    return sorted(r.window_end.strftime("%H:%M:%S") for r in df.collect())


def test_three_users_in_five_minutes_raise_an_alert(spark):
    found = alerts.detect(events(spark, COUPONS))
    assert ends(found) == ["00:03:00", "00:04:00", "00:05:00"]
    assert {r.uid_count for r in found.collect()} == {3}


def test_two_users_or_a_null_user_do_not(spark):
    assert alerts.detect(events(spark, COUPONS[:4])).count() == 0
    assert alerts.detect(events(spark, COUPONS[:4] + [("m", None, "coupon", "i", "00:02:30")])).count() == 0


def test_a_click_silences_its_windows_only(spark):
    clicked = events(spark, COUPONS + [("m", "u9", "clickItem", "i", "00:04:10")])
    assert ends(alerts.detect(clicked)) == ["00:03:00", "00:04:00"]
    elsewhere = events(spark, COUPONS + [("n", "u9", "clickItem", "i", "00:02:10")])
    assert len(ends(alerts.detect(elsewhere))) == 3


def test_documents_list_users_items_and_all_events(spark):
    docs = {r.id: r for r in alerts.documents(events(spark, COUPONS)).collect()}
    minute = 1704067200 // 60
    assert set(docs) == {f"m_{minute + k}" for k in (3, 4, 5)}
    first = docs[f"m_{minute + 3}"]
    assert (first.uids, first.itemIds) == (["u1", "u2", "u3"], ["i1", "i2", "i3"])
    assert first.events == ["addCart", "coupon", "coupon", "coupon", "coupon"]
    assert first.ts == (minute + 3) * 60_000


def test_finer_slides_keep_the_last_alert_of_a_minute(spark):
    last = alerts.last_per_minute(alerts.detect(events(spark, COUPONS), slide="5 seconds"))
    assert ends(last) == ["00:02:55", "00:03:55", "00:04:55", "00:05:30"]


def test_window_must_be_a_multiple_of_its_slide(spark):
    with pytest.raises(ValueError):
        alerts.detect(events(spark, COUPONS), "5 minutes", "2 minutes")


@pytest.mark.parametrize("block", ["1 minute", "2 hours", "3 hours 15 minutes", "1 day"])
def test_detection_equals_windows_written_out(spark, folder, block):
    from martpulse.sources import shop

    log = shop.event_log(spark, folder)
    plain = (
        log.groupBy(F.window(F.col("ts").cast("timestamp"), "2 hours", "15 minutes").alias("w"), "mid")
        .agg(F.count_distinct(F.when(alerts.is_coupon(), F.col("uid"))).alias("uid_count"),
             F.max(alerts.is_click()).alias("clicked"))
        .where("uid_count >= 3 and not clicked")
        .select("mid", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uid_count")
    )
    ours = alerts.detect(log, "2 hours", "15 minutes", block=block)
    assert ours.count() > 0
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


# --- document tables ----------------------------------------------------------------------------


def test_newest_document_wins_and_replays_do_no_harm(spark, tmp_path):
    schema = "id STRING, v INT, day STRING"
    path = str(tmp_path / "docs")

    def docs(*rows):
        return spark.createDataFrame(list(rows), schema)

    sinks.write_batch(docs(("a", 1, "d1"), ("b", 1, "d1")), 0, path, "day")
    sinks.write_batch(docs(("a", 2, "d1"), ("c", 1, "d2")), 1, path, "day")
    sinks.write_batch(docs(("a", 2, "d1"), ("c", 1, "d2")), 1, path, "day")
    sinks.write_batch(docs().limit(0), 2, path, "day")
    newest = sinks.read_latest(spark, path, schema, ["id"])
    assert sorted(map(tuple, newest.collect())) == [("a", 2, "d1"), ("b", 1, "d1"), ("c", 1, "d2")]
    assert sinks.read_all(spark, path, schema).count() == 4
    target = str(tmp_path / "compacted")
    sinks.compact(spark, path, target, schema, ["id"], "day")
    again = sinks.read_latest(spark, target, schema, ["id"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, newest.collect()))
    assert sinks.read_all(spark, target, schema).count() == 3


def test_change_entries_as_json(spark):
    entry = {"entry_type": "ROWDATA", "table_name": "user_info", "event_type": "INSERT",
             "exec_time": "2024-01-01T00:00:00", "rows": [[{"name": "id", "value": "1"}]]}
    rows = changes.flattened(changes.routed(changes_of(feed(spark, entry, "{broken")))).collect()
    assert [(r.topic, r.value, r.timestamp) for r in rows] == [("user_info", '{"id":"1"}', dt.datetime(2024, 1, 1))]


def test_both_ways_to_join_buyers_agree(spark):
    heads, lines, users = sale_inputs(spark)
    early, late = (sales.sale_detail(heads, lines, users, "2024-01-01", buyers_first=b) for b in (True, False))
    assert sorted(map(str, early.collect())) == sorted(map(str, late.collect()))


def test_random_events_against_brute_force(spark):
    """Many small devices at once, each window of each worked out by hand."""
    import random

    rnd, step, panes = random.Random(7), 60, 5
    rows, start = [], 1704067200
    for device in range(150):
        for _ in range(rnd.randrange(1, 25)):
            kind = rnd.choices(["coupon", "clickItem", "addCart"], [8, 1, 2])[0]
            user = rnd.choice([None, "a", "b", "c", "d"])
            rows.append((str(device), user, kind, str(rnd.randrange(9)), start + rnd.randrange(1500)))
    expected = set()
    for device in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == device]
        for end in range(start, start + 1500 + step * panes, step):
            inside = [r for r in mine if end - step * panes <= r[4] < end]
            users = {r[1] for r in inside if r[2] == "coupon" and r[1] is not None}
            if len(users) >= 3 and not any(r[2] == "clickItem" for r in inside):
                kinds = sorted(r[2] for r in inside)
                items = sorted({r[3] for r in inside if r[2] == "coupon"})
                expected.add((f"{device}_{end // 60}", tuple(sorted(users)), tuple(items), tuple(kinds)))
    log = spark.createDataFrame(rows, "mid STRING, uid STRING, evid STRING, itemid STRING, sec BIGINT")
    log = log.withColumn("ts", F.timestamp_seconds("sec"))
    got = {(r.id, tuple(r.uids), tuple(r.itemIds), tuple(r.events)) for r in alerts.documents(log).collect()}
    assert len(expected) > 50 and got == expected


class FakeSession:
    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})()


def test_folders_come_from_the_cluster(spark):
    from martpulse.session import work_dir

    assert work_dir(FakeSession("yarn", "s3a://shared/"), "x").startswith("s3a://shared/x-")
    with pytest.raises(ValueError):
        work_dir(FakeSession("yarn", None), "x")
    assert work_dir(FakeSession("local[2]", None), "x") != work_dir(FakeSession("local[2]", None), "x")


def test_upserted_documents_are_joined_once_and_shuffled_without_unused_columns(spark, folder):
    from martpulse.catalog import queries as Q

    found = Q.q26_upsert_docs(spark, folder)
    text = found._jdf.queryExecution().simpleString()
    assert "sku_name" not in text and "user_gender" not in text
    assert found.where("order_status = 'F'").isEmpty() and not found.where("order_status = 'DONE'").isEmpty()


def test_folded_days_are_not_folded_again(spark, tmp_path):
    from martpulse.sources import sinks

    path = str(tmp_path / "folds")
    rows = spark.createDataFrame([("a", 1, "d1"), ("b", 1, "d2")], "id STRING, n INT, day STRING")
    for batch in range(3):
        sinks.write_batch(rows.withColumn("n", F.lit(batch)), batch, path, "day")
    for _ in range(3):
        sinks.fold_days(spark, path, "id STRING, n INT, day STRING", ["day", "id"], "day", ["d1", "d2"], ["n"])
    batches = {n for n in sinks._names(spark, f"{path}/run=0") if sinks._names(spark, f"{path}/run=0/{n}/day=d1")}
    newest = sinks.read_latest(spark, path, "id STRING, n INT, day STRING", ["day", "id"], ["n"])
    assert sorted((r.id, r.n) for r in newest.collect()) == [("a", 2), ("b", 2)] and batches <= {"batch_id=2", "batch_id=3"}

