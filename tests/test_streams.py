"""Streaming jobs on hand-made feeds: order of arrival, late rows, restarts, replays."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from martpulse import schemas
from martpulse.session import stream_session
from martpulse.sources.feeds import file_feed
from martpulse.sources.sinks import read_all, read_latest
from martpulse.streaming import jobs

NOW = {"availableNow": True}


class Runner:
    """A job (or some, one after the other) over a growing folder; each ``send`` appends rows and runs it over them."""

    def __init__(self, spark, tmp_path, start, feeds=("in",)):
        self.spark, self.start = spark, start
        self.paths = {f: str(tmp_path / f) for f in feeds}
        self.table, self.checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
        for path in self.paths.values():
            spark.createDataFrame([], schemas.FEED).write.parquet(path)
        self.streams = stream_session(spark, partitions=2)
        self.reports = []

    def send(self, **messages):
        for feed, rows in messages.items():
            data = [("t", m if isinstance(m, str) else json.dumps(m), dt.datetime.fromisoformat(at), None) for at, m in rows]
            self.spark.createDataFrame(data, schemas.FEED).coalesce(1).write.mode("append").parquet(self.paths[feed])
        for begin in self.start if isinstance(self.start, list) else [self.start]:
            query = begin(self)
            assert query.awaitTermination(120)
            self.reports += query.recentProgress
        return self

    def feed(self, name="in"):
        return file_feed(self.streams, self.paths[name])


def log(at, mid, uid="u"):
    ms = int(dt.datetime.fromisoformat(at).replace(tzinfo=dt.UTC).timestamp() * 1000)
    return at, {"mid": mid, "uid": uid, "os": "x", "ts": ms}


@pytest.fixture
def devices(spark, tmp_path):
    return Runner(spark, tmp_path, lambda r: jobs.start_devices(r.feed(), r.table, r.checkpoint, NOW))


def logins(spark, runner):
    return sorted((r.mid, r.uid, r.log_date, r.log_hour) for r in read_all(spark, runner.table, jobs.DEVICE_TABLE).collect())


def test_device_counts_once_a_day_across_batches_and_restarts(spark, devices):
    devices.send(**{"in": [log("2024-01-01T09:00:00", "a", "late"), log("2024-01-01T08:00:00", "a", "first"),
                           log("2024-01-01T23:30:00", "b")]})
    assert logins(spark, devices) == [("a", "first", "2024-01-01", "08"), ("b", "u", "2024-01-01", "23")]
    devices.send(**{"in": [log("2024-01-01T23:40:00", "a"), log("2024-01-02T00:10:00", "a", "next")]})
    assert logins(spark, devices)[1] == ("a", "next", "2024-01-02", "00")
    devices.send(**{"in": [log("2024-01-02T05:00:00", "a"), log("2024-01-02T05:00:00", "c")]})
    assert [x[0] for x in logins(spark, devices)] == ["a", "a", "b", "c"]


def test_logs_of_a_closed_day_are_dropped_and_its_state_goes(spark, devices):
    devices.send(**{"in": [log("2024-01-01T10:00:00", "a"), log("2024-01-03T10:00:00", "b")]})
    devices.send(**{"in": [log("2024-01-01T11:00:00", "late"), log("2024-01-03T11:00:00", "c")]})
    assert [x[0] for x in logins(spark, devices)] == ["a", "b", "c"]
    states = [s for r in devices.reports for s in r.stateOperators]
    assert sum(s.numRowsDroppedByWatermark for s in states) == 1
    assert devices.reports[-1].stateOperators[0].numRowsTotal == 2


def test_malformed_messages_do_not_stop_the_job(spark, devices):
    devices.send(**{"in": [("2024-01-01T10:00:00", "{oops"), log("2024-01-01T10:00:00", "a")]})
    assert [x[0] for x in logins(spark, devices)] == ["a"]


def coupon(at, uid, kind="coupon", mid="m"):
    ms = int(dt.datetime.fromisoformat(at).replace(tzinfo=dt.UTC).timestamp() * 1000)
    return at, {"mid": mid, "uid": uid, "evid": kind, "itemid": f"i-{uid}", "ts": ms}


def alert_runner(spark, tmp_path, late="5 seconds"):
    def events(r):
        return r.table + "-events"

    return Runner(spark, tmp_path, [
        lambda r: jobs.start_landing(r.feed(), schemas.EVENT_LOG, events(r), r.checkpoint + "-landing", NOW, late),
        lambda r: jobs.start_alerts(r.streams, events(r), r.table, r.checkpoint, NOW, late=late),
        lambda r: jobs.start_late_alerts(r.streams, events(r), r.table + "-fixed", r.checkpoint + "-late", NOW),
    ])


def alert_docs(spark, runner):
    return jobs.stored_alerts(spark, runner.table, runner.table + "-fixed")


def test_alert_needs_three_users_and_no_click(spark, tmp_path):
    runner = alert_runner(spark, tmp_path)
    runner.send(**{"in": [coupon("2024-01-01T00:00:10", "u1"), coupon("2024-01-01T00:00:20", "u2"),
                          coupon("2024-01-01T00:00:30", "u2"), coupon("2024-01-01T00:00:40", "u1", "addCart"),
                          coupon("2024-01-01T00:00:10", "v1", mid="n"), coupon("2024-01-01T00:00:20", "v2", mid="n"),
                          coupon("2024-01-01T00:00:30", "v3", "clickItem", mid="n")]})
    runner.send(**{"in": [coupon("2024-01-01T00:01:10", "u3"), coupon("2024-01-01T00:01:20", "v3", mid="n"),
                          coupon("2024-01-01T00:03:10", "u4", "clickItem")]})
    runner.send(**{"in": [coupon("2024-01-01T01:00:00", "x", mid="tick")]})
    docs = alert_docs(spark, runner).where("mid = 'm'").orderBy("id").collect()
    minute = 1704067200 // 60
    assert [d.id for d in docs] == [f"m_{minute + 2}", f"m_{minute + 3}"]
    assert docs[0].uids == ["u1", "u2", "u3"] and docs[0].itemIds == ["i-u1", "i-u2", "i-u3"]
    assert docs[0].events == ["addCart", "coupon", "coupon", "coupon", "coupon"]
    silenced = alert_docs(spark, runner).where("mid = 'n'").collect()
    assert silenced == []


def test_late_events_raise_and_withdraw_alerts(spark, tmp_path):
    runner = alert_runner(spark, tmp_path)
    runner.send(**{"in": [coupon("2024-01-01T00:00:10", f"u{i}") for i in range(3)] + [coupon("2024-01-01T00:00:20", f"v{i}", mid="n") for i in range(2)]})
    runner.send(**{"in": [coupon("2024-01-01T01:00:00", "x", mid="tick")]})
    assert {d.mid for d in alert_docs(spark, runner).collect()} == {"m"}
    before = alert_docs(spark, runner).count()
    runner.send(**{"in": [coupon("2024-01-01T00:02:30", "u0", "clickItem"), coupon("2024-01-01T00:00:50", "v2", mid="n")]})
    found = sorted((d.id, tuple(d.uids)) for d in alert_docs(spark, runner).collect())
    minute = 1704067200 // 60
    assert [i for i, _ in found if i.startswith("m")] == [f"m_{minute + 1}", f"m_{minute + 2}"] and before == 5
    assert [u for i, u in found if i.startswith("n")] == [("v0", "v1", "v2")] * 5
    marks = [s for r in runner.reports for s in r.stateOperators]
    assert sum(s.numRowsDroppedByWatermark for s in marks) == 0


def test_state_of_alerts_does_not_grow_with_traffic(spark, tmp_path):
    rows = [0, 0]
    for i, many in enumerate((1, 200)):
        runner = alert_runner(spark, tmp_path / str(i))
        actions = [coupon("2024-01-01T00:00:10", f"u{u}", kind) for u in range(2) for kind in ("coupon", "addCart", "error") for _ in range(many)]
        runner.send(**{"in": actions})
        last = next(r for r in reversed(runner.reports) if len(r.stateOperators) == 3)
        rows[i] = sum(s.numRowsTotal for s in last.stateOperators)
    assert rows[0] == rows[1] > 0


def order(at, id_, user="u1"):
    return at, {"id": id_, "order_status": "1001", "create_time": at.replace("T", " "), "user_id": user,
                "total_amount": "5.0", "consignee_tel": "13812345678"}


def line(at, id_, order_id, price="2.5"):
    return at, {"id": id_, "order_id": order_id, "sku_id": "s", "sku_name": "ring", "order_price": price}


USERS = [("u1", "M", dt.date(2000, 1, 1), "2")]


def sale_runner(spark, tmp_path, **options):
    def users(buyers):
        return buyers.sparkSession.createDataFrame(USERS, "id STRING, gender STRING, birthday DATE, user_level STRING")

    return Runner(
        spark, tmp_path,
        lambda r: jobs.start_sales(r.feed("orders"), r.feed("lines"), users, r.table, r.checkpoint, "2024-01-01", NOW,
                                   **options),
        ("orders", "lines"),
    )


def sold(spark, runner):
    docs = read_latest(spark, runner.table, jobs.SALE_TABLE, ["order_detail_id"])
    return {d.order_detail_id: d for d in docs.collect()}


def test_orders_and_lines_wait_for_each_other(spark, tmp_path):
    runner = sale_runner(spark, tmp_path)
    runner.send(orders=[order("2024-01-01T10:00:00", "1")], lines=[line("2024-01-01T10:00:00", "d1", "1"),
                                                                  line("2024-01-01T10:00:00", "d2", "2")])
    assert set(sold(spark, runner)) == {"d1"}
    runner.send(orders=[order("2024-01-01T10:00:50", "2", "ghost")], lines=[line("2024-01-01T10:01:00", "d3", "1")])
    docs = sold(spark, runner)
    assert set(docs) == {"d1", "d2", "d3"}
    assert (docs["d1"].user_gender, docs["d1"].user_age, docs["d1"].sku_price) == ("M", 24, 2.5)
    assert (docs["d2"].user_id, docs["d2"].user_age, docs["d2"].user_gender) == ("ghost", 0, None)
    runner.send(orders=[order("2024-01-01T11:00:00", "7")], lines=[line("2024-01-01T11:00:00", "d9", "1")])
    assert set(sold(spark, runner)) == {"d1", "d2", "d3"}


def test_early_lines_can_be_dropped(spark, tmp_path):
    runner = sale_runner(spark, tmp_path, early_details="drop")
    runner.send(orders=[order("2024-01-01T10:00:10", "1")], lines=[line("2024-01-01T10:00:00", "d1", "1"),
                                                                  line("2024-01-01T10:00:10", "d2", "1")])
    assert set(sold(spark, runner)) == {"d2"}


def test_an_order_sent_again_replaces_its_documents(spark, tmp_path):
    runner = sale_runner(spark, tmp_path)
    runner.send(orders=[order("2024-01-01T10:00:00", "1", "ghost")], lines=[line("2024-01-01T10:00:00", "d1", "1")])
    runner.send(orders=[order("2024-01-01T10:00:30", "1", "u1")], lines=[])
    docs = sold(spark, runner)
    assert set(docs) == {"d1"} and docs["d1"].user_gender == "M"


def test_one_order_with_most_lines_is_spread_and_whole(spark, tmp_path):
    at = "2024-01-01T10:00:00"
    runner = sale_runner(spark, tmp_path, salts=4)
    runner.send(orders=[order(at, "hot"), order(at, "cold")],
                lines=[line(at, f"h{i}", "hot") for i in range(300)] + [line(at, "c", "cold")])
    assert len(sold(spark, runner)) == 301


def test_orders_are_masked_dated_and_upserted(spark, tmp_path):
    runner = Runner(spark, tmp_path, lambda r: jobs.start_orders(r.feed(), r.table, r.checkpoint, NOW))
    first, again = order("2024-01-01T10:00:00", "1"), order("2024-01-01T10:00:00", "1")
    again[1]["total_amount"] = "8.0"
    runner.send(**{"in": [first, order("2024-01-02T11:00:00", "2")]}).send(**{"in": [("2024-01-01T12:00:00", again[1])]})
    rows = read_latest(spark, runner.table, jobs.ORDER_TABLE, ["id"], ["seen_at"]).orderBy("id").collect()
    assert [(r.id, r.total_amount, r.create_date, r.create_hour, r.consignee_tel) for r in rows] == [
        ("1", 8.0, "2024-01-01", "10", "1381*********"), ("2", 5.0, "2024-01-02", "11", "1381*********")]


def test_users_keep_their_newest_record(spark, tmp_path):
    runner = Runner(spark, tmp_path, lambda r: jobs.start_users(r.feed(), r.table, r.checkpoint, NOW))
    runner.send(**{"in": [("2024-01-01T10:00:00", {"id": "1", "user_level": "1", "birthday": "2000-01-01"}),
                          ("2024-01-01T10:00:01", {"id": "1", "user_level": "2", "birthday": "2000-01-01"})]})
    runner.send(**{"in": [("2024-01-01T10:00:05", {"id": "2", "user_level": "1"})]})
    runner.send(**{"in": [("2024-01-01T10:00:09", {"id": "1", "user_level": "3"})]})
    assert sorted((r.id, r.user_level) for r in jobs.current_users(spark, runner.table).collect()) == [("1", "3"), ("2", "1")]
    only = spark.createDataFrame([("1",), ("9",)], "id STRING")
    assert [(r.id, r.user_level) for r in jobs.current_users(spark, runner.table, only).collect()] == [("1", "3")]


def test_a_batch_that_fails_is_run_again_without_doubles(spark, tmp_path, monkeypatch):
    runner = Runner(spark, tmp_path, lambda r: jobs.start_orders(r.feed(), r.table, r.checkpoint, NOW))
    write, calls = jobs.write_batch, []

    def failing(rows, batch_id, path, partition=None):
        write(rows, batch_id, path, partition)
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(jobs, "write_batch", failing)
    with pytest.raises(Exception):
        runner.send(**{"in": [order("2024-01-01T10:00:00", "1")]})
    runner.send()
    assert calls == [0, 0]
    assert read_all(spark, runner.table, jobs.ORDER_TABLE).count() == 1


def test_batches_report_rows_before_and_after_the_seen_filter(spark, devices):
    devices.send(**{"in": [log("2024-01-01T09:00:00", "a"), log("2024-01-01T09:01:00", "a"), log("2024-01-01T09:00:00", "b")]})
    counts = devices.reports[0].observedMetrics
    assert (counts["logs"].rows, counts["new_logins"].rows) == (3, 2)


def test_console_sink_runs(spark, tmp_path):
    runner = Runner(spark, tmp_path, lambda r: jobs.to_console(r.feed(), r.checkpoint, NOW))
    runner.send(**{"in": [("2024-01-01T10:00:00", {"id": "1"})]})
    assert "Console" in runner.reports[0].sink.description and runner.reports[0].numInputRows == 1


def test_a_compacted_table_takes_over_with_the_same_checkpoint(spark, tmp_path):
    from martpulse.sources.sinks import compact

    runner = Runner(spark, tmp_path, lambda r: jobs.start_orders(r.feed(), r.table, r.checkpoint, NOW))
    runner.send(**{"in": [order("2024-01-01T10:00:00", "1"), order("2024-01-01T10:00:00", "2")]})
    runner.send(**{"in": [order("2024-01-01T10:00:00", "2", "u2")]})
    folded = str(tmp_path / "folded")
    compact(spark, runner.table, folded, jobs.ORDER_TABLE, ["id"], "create_period", ["seen_at"])
    runner.table = folded
    runner.send(**{"in": [("2024-01-01T12:00:00", order("2024-01-01T10:00:00", "1", "u3")[1])]})
    rows = read_latest(spark, folded, jobs.ORDER_TABLE, ["id"], ["seen_at"])
    assert sorted((r.id, r.user_id) for r in rows.collect()) == [("1", "u3"), ("2", "u2")]
    assert read_all(spark, folded, jobs.ORDER_TABLE).count() == 3


# --- tables that outlive a checkpoint -----------------------------------------------------------


def test_a_new_checkpoint_keeps_old_rows_and_still_upserts(spark, tmp_path):
    runner = Runner(spark, tmp_path, lambda r: jobs.start_orders(r.feed(), r.table, r.checkpoint, NOW))
    runner.send(**{"in": [order("2024-01-01T10:00:00", "1"), order("2024-01-01T10:00:00", "2")]})
    runner.checkpoint = str(tmp_path / "another")
    spark.createDataFrame([], schemas.FEED).write.parquet(str(tmp_path / "later"))
    runner.paths["in"] = str(tmp_path / "later")
    runner.send(**{"in": [("2024-01-01T12:00:00", order("2024-01-01T10:00:00", "2", "u2")[1]), order("2024-01-01T13:00:00", "3")]})
    runner.send(**{"in": [order("2024-01-01T14:00:00", "4")]})
    rows = jobs.stored_orders(spark, runner.table)
    assert sorted((r.id, r.user_id) for r in rows.collect()) == [("1", "u1"), ("2", "u2"), ("3", "u1"), ("4", "u1")]
    runs = {(r.run, r.batch_id) for r in read_all(spark, runner.table, jobs.ORDER_TABLE).collect()}
    assert runs == {(1, 0), (2, 0), (2, 1)}


def test_an_old_feed_gone_over_again_leaves_newer_rows(spark, tmp_path):
    """Newest is what was seen last, not what was written last; folding keeps it so."""
    runner = Runner(spark, tmp_path, lambda r: jobs.start_orders(r.feed(), r.table, r.checkpoint, NOW))
    runner.send(**{"in": [("2024-01-05T10:00:00", order("2024-01-01T10:00:00", "1", "new")[1])]})
    runner.checkpoint = str(tmp_path / "another")
    spark.createDataFrame([], schemas.FEED).write.parquet(str(tmp_path / "old"))
    runner.paths["in"] = str(tmp_path / "old")
    runner.send(**{"in": [order("2024-01-01T10:00:00", "1", "old"), order("2024-01-01T11:00:00", "2", "other")]})
    runner.send(**{"in": [order("2024-01-01T12:00:00", "3", "third")]})
    for _ in range(3):
        rows = {r.id: r.user_id for r in jobs.stored_orders(spark, runner.table).collect()}
        assert rows == {"1": "new", "2": "other", "3": "third"}
        jobs.fold_orders(spark, runner.table, ["2024-01-01"])


def test_sales_keep_the_times_that_decide(spark, tmp_path):
    runner = sale_runner(spark, tmp_path)
    runner.send(orders=[order("2024-01-01T10:00:00", "1")], lines=[line("2024-01-01T10:00:30", "d", "1", "9.0")])
    runner.send(orders=[order("2024-01-01T10:00:10", "1")], lines=[line("2024-01-01T10:00:20", "d", "1", "1.0")])
    docs = jobs.stored_sales(spark, runner.table)
    assert [(r.order_detail_id, r.sku_price) for r in docs.collect()] == [("d", 9.0)]
    assert docs.first().order_ts == dt.datetime(2024, 1, 1, 10, 0, 10)


# --- rows that come late, wait in vain or are looked up -----------------------------------------------


def late_runner(spark, tmp_path):
    return Runner(spark, tmp_path, [
        lambda r: jobs.start_landing(r.feed(), schemas.STARTUP_LOG, r.table + "-logs", r.checkpoint + "-landing", NOW),
        lambda r: jobs.start_landed_devices(r.streams, r.table + "-logs", r.table, r.checkpoint, NOW),
        lambda r: jobs.start_late_devices(r.streams, r.table + "-logs", r.table, r.table + "-fixed", r.checkpoint + "-late", NOW),
        lambda r: jobs.start_first_seen(r.streams, [r.table, r.table + "-fixed"], r.table + "-seen", r.checkpoint + "-seen", NOW, buckets=3),
    ])


def test_late_logs_are_folded_into_closed_days(spark, tmp_path):
    from martpulse.operators.keyed import first_per
    from martpulse.plans import devices as plans

    runner = late_runner(spark, tmp_path)

    def stored():
        return jobs.stored_devices(spark, runner.table, runner.table + "-fixed")

    def found():
        rows = first_per(stored(), ["mid", "log_date"], ["ts", "uid"])
        return sorted((r.mid, r.uid, r.log_date, r.log_hour) for r in rows.collect())

    def new_on(day):
        return sorted(r.mid for r in jobs.first_seen_on(spark, runner.table + "-seen", F.lit(day)).collect())

    runner.send(**{"in": [log("2024-01-01T10:00:00", "a", "late"), log("2024-01-03T10:00:00", "b")]})
    assert new_on("2024-01-01") == ["a"] and new_on("2024-01-03") == ["b"]
    runner.send(**{"in": [log("2024-01-01T09:00:00", "a", "first"), log("2024-01-01T11:00:00", "a", "no"), log("2024-01-02T11:00:00", "b", "early"),
                          log("2024-01-02T23:30:00", "c"), log("2024-01-03T09:30:00", "d")]})
    want = [("a", "first", "2024-01-01", "09"), ("b", "early", "2024-01-02", "11"), ("b", "u", "2024-01-03", "10"),
            ("c", "u", "2024-01-02", "23"), ("d", "u", "2024-01-03", "09")]
    assert found() == want
    assert [plans.stored_total(stored(), f"2024-01-0{d}").first().dau for d in (1, 2, 3)] == [1, 2, 2]
    assert [new_on(f"2024-01-0{d}") for d in (1, 2, 3)] == [["a"], ["b", "c"], ["d"]]
    fixed = read_all(spark, runner.table + "-fixed", jobs.DEVICE_TABLE)
    assert {(r.mid, r.log_hour) for r in fixed.collect()} == {("a", "09"), ("b", "11"), ("c", "23")}, "the log of 11 o'clock changes nothing"
    runner.send(**{"in": [log("2024-01-01T09:00:00", "a", "first"), log("2024-01-02T11:00:00", "b", "early"), log("2024-01-01T08:00:00", "c")]})
    assert found()[-2:] == [("c", "u", "2024-01-02", "23"), ("d", "u", "2024-01-03", "09")] and len(found()) == 6
    assert [new_on(f"2024-01-0{d}") for d in (1, 2, 3)] == [["a", "c"], ["b"], ["d"]]
    assert read_all(spark, runner.table + "-fixed", jobs.DEVICE_TABLE).count() == 4, "a feed delivered twice changes no table"
    assert sum(s.numRowsDroppedByWatermark for r in runner.reports for s in r.stateOperators) == 0


def test_a_shuffled_feed_loses_nothing(spark, tmp_path):
    import random

    rng = random.Random(5)
    logs = [log(f"2024-01-{1 + i % 9:02d}T{rng.randrange(24):02d}:{rng.randrange(60):02d}:00", f"m{rng.randrange(12)}", f"u{i}") for i in range(240)]
    first = {}
    for _, m in logs:
        key = (m["mid"], dt.datetime.fromtimestamp(m["ts"] / 1000, dt.UTC).strftime("%Y-%m-%d"))
        first[key] = min(first.get(key, (m["ts"], m["uid"])), (m["ts"], m["uid"]))
    rng.shuffle(logs)
    logs = [("2024-02-01T00:00:00", m) for _, m in logs]
    runner = late_runner(spark, tmp_path)
    for i in range(0, 240, 80):
        runner.send(**{"in": logs[i : i + 80]})
    from martpulse.operators.keyed import first_per

    rows = first_per(jobs.stored_devices(spark, runner.table, runner.table + "-fixed"), ["mid", "log_date"], ["ts", "uid"])
    assert {(r.mid, r.log_date): (r.ts, r.uid) for r in rows.collect()} == first
    news = {r.mid: d for d in sorted({d for _, d in first}) for r in jobs.first_seen_on(spark, runner.table + "-seen", F.lit(d)).collect()}
    assert news == {m: min(d for n, d in first if n == m) for m, _ in first}


def test_a_landing_batch_done_again_keeps_its_marks(spark, tmp_path):
    from martpulse.sources import sinks

    path = str(tmp_path / "t")
    assert sinks.latest_mark(spark, path, 1, 0) is None
    for batch, mark in enumerate((5, 9, 12)):
        sinks.put_mark(spark, path, 1, batch, mark)
    assert sinks.latest_mark(spark, path, 1, 2) == 9 and sinks.latest_mark(spark, path, 1, 3) == 12
    assert sinks.latest_mark(spark, path, 2, 0) == 12


def test_batches_hold_their_devices_against_the_stored_set(spark, tmp_path):
    table = str(tmp_path / "table")
    rows = spark.createDataFrame(
        [(i, f"m{i % 7}", dt.datetime(2024, 1, 1 + i % 3, i % 24)) for i in range(200)], "event_id long, mid string, ts timestamp"
    )
    for batch in (0, 1, 1, 2):
        jobs.write_unseen(rows.where(F.floor(F.hour("ts") / 8) == batch), batch, table)
    found = sorted((r.mid, str(r.log_date), r.batch_id, r.event_id) for r in spark.read.option("basePath", table).parquet(table).collect())
    from martpulse.plans import devices as plans

    want = sorted((r.mid, r.log_date, int(r.log_hour) // 8, r.event_id) for r in plans.first_logins(rows).collect())
    assert found == want


def test_what_never_met_is_reported_when_its_time_is_over(spark, tmp_path):
    runner = Runner(spark, tmp_path, lambda r: jobs.start_unmatched(r.feed("orders"), r.feed("lines"), r.table, r.checkpoint, NOW), ("orders", "lines"))
    runner.send(orders=[order("2024-01-01T10:00:00", "met"), order("2024-01-01T10:00:00", "alone"), order("2024-01-01T10:00:00", "late")],
                lines=[line("2024-01-01T10:00:50", "d1", "met"), line("2024-01-01T10:00:20", "d2", "none"), line("2024-01-01T10:00:21", "d3", "none")])

    def found():
        rows = read_all(spark, runner.table, jobs.UNMATCHED_TABLE) if jobs.any_rows(spark, runner.table) else None
        return sorted((r.order_id, r.order_detail_id or "", r.status) for r in rows.collect()) if rows is not None else []

    assert found() == []
    runner.send(orders=[order("2024-01-01T10:10:00", "x")], lines=[line("2024-01-01T10:01:35", "d4", "late"), line("2024-01-01T10:10:00", "d5", "x")])
    runner.send(orders=[order("2024-01-01T10:20:00", "y")], lines=[line("2024-01-01T10:20:00", "d6", "y")])
    assert found() == [("alone", "", "order_only"), ("none", "d2", "detail_only"), ("none", "d3", "detail_only")]


def slots(runner):
    from pathlib import Path

    return {(p.parent.name, p.name) for p in Path(runner.checkpoint, "waiting").glob("run=*/batch_id=*/side=*/slot=*")}


def test_waiting_rows_are_kept_by_slot_and_go_with_the_watermark(spark, tmp_path):
    """No row costs a lookup in a state store, and what waits does not grow with the feed."""
    runner = sale_runner(spark, tmp_path)
    for minute in range(0, 50, 5):
        at = f"2024-01-01T10:{minute:02}:00"
        runner.send(orders=[order(at, f"o{minute}")], lines=[line(at[:-2] + "20", f"d{minute}", f"o{minute}"),
                                                              line(at, f"e{minute}", f"o{minute - 5}")])
    assert set(sold(spark, runner)) == {f"d{minute}" for minute in range(0, 50, 5)}
    assert not any(r.stateOperators for r in runner.reports) and 0 < len(slots(runner)) <= 12
    runner.send(orders=[order("2024-01-01T10:40:00", "late")], lines=[line("2024-01-01T10:45:10", "f", "late"), line("2024-01-01T10:45:30", "g", "o45")])
    assert set(sold(spark, runner)) == {f"d{minute}" for minute in range(0, 50, 5)} | {"g"}


@pytest.mark.parametrize("lost", ["before the marks", "after the marks"])
def test_a_batch_of_waiting_rows_that_fails_is_run_again_without_doubles(spark, tmp_path, monkeypatch, lost):
    sale = sale_runner(spark, tmp_path)
    (tmp_path / "other").mkdir()
    alone = Runner(spark, tmp_path / "other", lambda r: jobs.start_unmatched(r.feed("orders"), r.feed("lines"), r.table, r.checkpoint, NOW), ("orders", "lines"))
    for runner in (sale, alone):
        runner.send(orders=[order("2024-01-01T10:00:00", "1"), order("2024-01-01T10:00:00", "2")], lines=[line("2024-01-01T10:00:10", "a", "1")])
        done, calls = jobs.Waiting.done, []

        def failing(self, done=done, calls=calls):
            calls.append(self.batch_id)
            if len(calls) == 1:
                if lost == "after the marks":
                    done(self)
                raise RuntimeError("lost")
            done(self)

        more = {"orders": [order("2024-01-01T10:20:00", "3"), order("2024-01-01T10:00:20", "4")], "lines": [line("2024-01-01T10:01:00", "b", "1"), line("2024-01-01T10:20:00", "c", "3")]}
        with monkeypatch.context() as patch:
            patch.setattr(jobs.Waiting, "done", failing)
            with pytest.raises(Exception):
                runner.send(**more)
            runner.send()
        assert calls == [1, 1]
        runner.send(orders=[order("2024-01-01T11:00:00", "5")], lines=[line("2024-01-01T11:00:00", "d", "5")])
    docs = read_all(spark, sale.table, jobs.SALE_TABLE).collect()
    assert sorted(d.order_detail_id for d in docs) == ["a", "b", "c", "d"]
    rows = read_all(spark, alone.table, jobs.UNMATCHED_TABLE).collect()
    assert sorted((r.order_id, r.status) for r in rows) == [("2", "order_only"), ("4", "order_only")]


def test_closed_days_are_folded_beside_the_running_job(spark, tmp_path):
    from martpulse.sources.sinks import fold_days

    runner = Runner(spark, tmp_path, lambda r: jobs.start_orders(r.feed(), r.table, r.checkpoint, NOW))
    keys = ["create_period", "id"]
    for hour, user in ((10, "a"), (11, "b"), (12, "c")):
        again = ("2024-01-01T%02d:30:00" % hour, order("2024-01-01T10:00:00", "1", user)[1])
        runner.send(**{"in": [again, order("2024-01-01T%02d:00:00" % hour, f"x{hour}"), order("2024-01-02T09:00:00", f"y{hour}")]})
    runner.send(**{"in": [order("2024-01-03T09:00:00", "z")]})
    before = sorted(map(tuple, jobs.stored_orders(spark, runner.table).collect()))
    fold_days(spark, runner.table, jobs.ORDER_TABLE, keys, "create_period", ["2024-01-01"], ["seen_at"])
    assert sorted(map(tuple, jobs.stored_orders(spark, runner.table).collect())) == before
    kept = read_all(spark, runner.table, jobs.ORDER_TABLE).where("create_period = '2024-01-01'")
    assert (0, 0) in {(r.run, r.batch_id) for r in kept.collect()} and kept.count() > 4, "a reader may still be at the old folders"
    fold_days(spark, runner.table, jobs.ORDER_TABLE, keys, "create_period", ["2024-01-01"], ["seen_at"])
    kept = read_all(spark, runner.table, jobs.ORDER_TABLE).where("create_period = '2024-01-01'")
    assert kept.count() == 4 and {(r.run, r.batch_id) for r in kept.collect()} == {(0, 0)}
    runner.send(**{"in": [("2024-01-03T10:00:00", order("2024-01-01T10:00:00", "1", "d")[1])]})
    runner.send(**{"in": [order("2024-01-03T11:00:00", "zz")]})
    fold_days(spark, runner.table, jobs.ORDER_TABLE, keys, "create_period", ["2024-01-01"], ["seen_at"])
    rows = {r.id: r.user_id for r in jobs.stored_orders(spark, runner.table).collect()}
    assert rows["1"] == "d" and len(rows) == 9


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_questions_to_stored_tables_prune_days_and_columns(spark, tmp_path):
    from martpulse.plans import orders as order_plans

    runner = Runner(spark, tmp_path, lambda r: jobs.start_orders(r.feed(), r.table, r.checkpoint, NOW))
    runner.send(**{"in": [order("2024-01-01T10:00:00", "1"), order("2024-01-02T10:00:00", "2")]})
    stored = jobs.stored_orders(spark, runner.table, ["total_amount", "create_hour"])
    asked = plan(order_plans.turnover(stored, "2024-01-01"))
    scan = asked[asked.index("FileScan"):]
    assert "create_period" in scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    assert "consignee" not in scan[scan.index("ReadSchema"):] and "EqualTo(create_date,2024-01-01)" in scan or "In(create_date" in scan


def test_buyers_are_read_from_their_buckets_only(spark, tmp_path):
    runner = Runner(spark, tmp_path, lambda r: jobs.start_users(r.feed(), r.table, r.checkpoint, NOW))
    runner.send(**{"in": [("2024-01-01T10:00:00", {"id": str(i), "user_level": "1"}) for i in range(50)]})
    only = spark.createDataFrame([("7",)], "id STRING")
    asked = jobs.current_users(spark, runner.table, only)
    assert [r.id for r in asked.collect()] == ["7"]
    text = plan(asked)
    assert "PartitionFilters: [bucket" in text or "PartitionFilters: [isnotnull(bucket" in text


def test_stored_devices_answer_the_dashboard(spark, devices):
    from martpulse.plans import cards
    from martpulse.plans import devices as device_plans

    devices.send(**{"in": [log("2024-01-01T09:00:00", "a"), log("2024-01-01T23:30:00", "b"), log("2024-01-02T00:10:00", "a")]})
    stored = jobs.stored_devices(spark, devices.table)
    assert device_plans.stored_total(stored, "2024-01-01").first().dau == 2
    hours = {r.hour: (r.yesterday, r.today) for r in cards.hourly_compare("dau", stored, "2024-01-02").collect()}
    assert len(hours) == 24 and hours["09"] == (1, 0) and hours["00"] == (0, 1)
    assert json.loads(cards.hourly_json("dau", stored, "2024-01-02").first().response) == {"yesterday": {"09": 1, "23": 1}, "today": {"00": 1}}


# --- clocks and messages that are wrong ---------------------------------------------------------


def test_a_wrong_clock_or_number_costs_only_its_own_row(spark, tmp_path, devices):
    huge = ("2024-01-01T10:00:00", {"mid": "huge", "ts": 2**63 - 1})
    text = ("2024-01-01T10:00:00", {"mid": "text", "ts": "soon"})
    future = ("2024-01-01T10:00:00", log("2030-01-01T00:00:00", "future")[1])
    devices.send(**{"in": [log("2024-01-01T10:00:00", "a"), huge, text, future, ("2024-01-01T10:00:00", "{oops")]})
    devices.send(**{"in": [log("2024-01-01T11:00:00", "b"), log("2024-01-01T12:00:00", "c")]})
    assert [x[0] for x in logins(spark, devices)] == ["a", "b", "c"]

    table = str(tmp_path / "aside")
    query = jobs.start_aside(devices.feed(), schemas.STARTUP_LOG, "mid", table, str(tmp_path / "aside-checkpoint"), NOW)
    assert query.awaitTermination(120)
    rows = read_all(spark, table, jobs.ASIDE_TABLE).collect()
    assert sorted(r.why for r in rows) == ["ahead", "malformed", "malformed", "malformed"]


def test_images_of_one_entry_keep_their_order(spark, tmp_path):
    """Two images of a user in one change entry share their time; the later one stays, in either order of the files."""
    at = dt.datetime(2024, 1, 1, 10)
    images = [("t", json.dumps({"id": "1", "user_level": str(pos)}), at, pos) for pos in range(2)]
    for name, rows in (("up", images), ("down", images[::-1])):
        folder = tmp_path / name
        spark.createDataFrame([], schemas.FEED).write.parquet(str(folder / "in"))
        for row in rows:
            spark.createDataFrame([row], schemas.FEED).coalesce(1).write.mode("append").parquet(str(folder / "in"))
        feed = file_feed(stream_session(spark, partitions=2), str(folder / "in"), 1)
        assert jobs.start_users(feed, str(folder / "table"), str(folder / "checkpoint"), NOW).awaitTermination(120)
        assert [r.user_level for r in jobs.current_users(spark, str(folder / "table")).collect()] == ["1"]


def test_rows_without_a_device_alert_nowhere(spark):
    from martpulse.plans import alerts

    rows = [(None, f"u{i}", "coupon", "i", dt.datetime(2024, 1, 1, 10, i)) for i in range(4)]
    events = spark.createDataFrame(rows, "mid STRING, uid STRING, evid STRING, itemid STRING, ts TIMESTAMP")
    assert alerts.detect(events, "1 hour", "10 minutes").count() == 0
    assert alerts.documents(events, "1 hour", "10 minutes").count() == 0


def test_odd_hours_and_hours_that_sum_to_nothing_stay(spark):
    from martpulse.plans import cards

    rows = [("2024-01-01", "10", 5.0), ("2024-01-01", "10", -5.0), ("2024-01-01", "", 3.0), ("2024-01-01", "11", float("nan")), ("2024-01-01", "11", 1e20)]
    orders = spark.createDataFrame(rows, "create_date STRING, create_hour STRING, total_amount DOUBLE")
    series = {r.hour: r.today for r in cards.hourly_compare("order_amount", orders, "2024-01-01").collect()}
    assert len(series) == 25 and series["other"] == 3.0 and series["10"] == 0.0
    answer = json.loads(cards.hourly_json("order_amount", orders, "2024-01-01").first().response)
    assert answer["today"] == {"": 3.0, "10": 0.0}


def test_console_on_a_clock_trigger(spark, tmp_path):
    spark.createDataFrame([], schemas.FEED).write.parquet(str(tmp_path / "in"))
    feed = file_feed(stream_session(spark, partitions=2), str(tmp_path / "in"))
    query = jobs.to_console(feed, str(tmp_path / "checkpoint"), {"processingTime": "1 second"})
    try:
        assert query.isActive
        query.processAllAvailable()
    finally:
        query.stop()


def test_the_word_index_leads_to_the_newest_documents(spark, tmp_path):
    words = str(tmp_path / "words")
    runner = sale_runner(spark, tmp_path, words=words)

    def named(at, id_, order_id, name):
        when, row = line(at, id_, order_id)
        return when, {**row, "sku_name": name}

    runner.send(orders=[order("2024-01-01T10:00:00", "1")], lines=[
        named("2024-01-01T10:00:01", "a", "1", "Red Ring"), named("2024-01-01T10:00:02", "b", "1", "red-blue ring, red"), named("2024-01-01T10:00:03", "c", "1", "Ring"),
        named("2024-01-01T10:00:04", "d", "1", None)])
    runner.send(orders=[order("2024-01-02T10:00:00", "2")], lines=[
        named("2024-01-02T10:00:01", "e", "2", "ring RED"), named("2024-01-01T10:00:30", "a", "1", "Green Ring"), named("2024-01-01T10:00:30", "c", "1", "red ring")])

    def found(keyword, date=None):
        return sorted(r.order_detail_id for r in jobs.indexed_sales(spark, runner.table, words, keyword, date).collect())

    assert found("red ring") == ["b", "c", "e"] and found("RING red", "2024-01-01") == ["b", "c"]
    assert found("ring") == ["a", "b", "c", "e"] and found("nothing") == [] == found("...")
    text = plan(jobs.indexed_sales(spark, runner.table, words, "red ring", "2024-01-01"))
    scans = [s[: s.index("ReadSchema")] for s in text.split("FileScan")[1:]]
    index = next(s for s in scans if "words" in s)
    assert "bucket" in index[index.index("PartitionFilters"):] and "sale_period" in index[index.index("PartitionFilters"):]


# --- places in the log ------------------------------------------------------------------------------


def test_a_feed_delivered_again_changes_no_table(spark, tmp_path):
    runner = alert_runner(spark, tmp_path, late="1 hour")
    path = runner.paths["in"]
    said = [coupon("2024-01-01T00:00:10", f"u{i % 3}") for i in range(7)] + [coupon("2024-01-01T02:00:00", "x", mid="tick")]
    message = [("t", json.dumps(m), dt.datetime.fromisoformat(at), None, i % 2, i // 2) for i, (at, m) in enumerate(said)]

    def deliver(*messages, checkpoint=""):
        runner.checkpoint += checkpoint
        if messages:
            spark.createDataFrame(list(messages), schemas.PLACED_FEED).coalesce(1).write.mode("append").parquet(path)
        runner.send()

    def tables():
        kept = spark.read.schema(jobs.landed_schema(schemas.EVENT_LOG)).parquet(runner.table + "-events")
        docs = sorted((d.id, tuple(d.uids), tuple(d.itemIds), tuple(d.events)) for d in alert_docs(spark, runner).collect())
        return sorted((r.mid, r.uid, r.ts) for r in kept.collect()), docs

    deliver(*message, *message[:3])  # some twice within a batch
    rows, docs = tables()
    assert len(rows) == len(message) and docs and all(d[3] == ("coupon",) * 7 for d in docs)
    deliver(*message)  # all in a later batch
    assert tables() == (rows, docs)
    deliver(checkpoint="-new")  # all three deliveries to jobs with new checkpoints
    assert tables() == (rows, docs)
    other = ("t", json.dumps(coupon("2024-01-01T02:00:01", "y", mid="tick")[1]), dt.datetime(2024, 1, 1, 2, 0, 1), None, 0, 4)
    deliver(other, message[0])
    assert len(tables()[0]) == len(rows) + 1


def test_taken_places_are_runs_without_gaps(spark):
    from martpulse.sources import positions

    places = [("t", 0, o) for o in (1, 2, 3, 5, 6, 6, 4095, 4096, 4097)] + [("t", 1, 3), (None, None, 7), ("t", 0, None)]
    rows = spark.createDataFrame(places, "topic string, partition int, offset bigint")
    runs = {(r.topic, r.partition, r.low, r.high) for r in positions.taken_by(rows).collect()}
    assert runs == {("t", 0, 1, 3), ("t", 0, 5, 6), ("t", 0, 4095, 4095), ("t", 0, 4096, 4097), ("t", 1, 3, 3), (None, None, 7, 7)}
    again = spark.createDataFrame([*places, ("t", 0, 4), ("t", 0, 4), ("u", 0, 1), ("t", 0, None)], rows.schema)
    left = positions.not_taken(again, positions.taken_by(rows)).collect()
    assert sorted((r.topic, r.partition, r.offset or 0) for r in left) == [("t", 0, 0), ("t", 0, 0), ("t", 0, 4), ("u", 0, 1)]
    plain = spark.createDataFrame([("t", "v")], "topic string, value string")
    assert positions.placed(plain).dtypes[-2:] == [("partition", "int"), ("offset", "bigint")]
    assert positions.not_taken(positions.placed(plain), positions.taken_by(rows)).count() == 1
