"""Database changes all the way to searchable sale documents, each step its own streaming job."""

import datetime as dt
import json

from martpulse import constants as K
from martpulse import schemas
from martpulse.plans import search
from martpulse.session import stream_session
from martpulse.sources.feeds import file_changes, file_feed, topic_of
from martpulse.sources.sinks import read_latest
from martpulse.streaming import jobs

NOW = {"availableNow": True}


def entry(table, event, *images, at="2024-01-01T10:00:00"):
    return ("ROWDATA", table, event, dt.datetime.fromisoformat(at), [list(i.items()) for i in images])


def user(level):
    return {"id": "u1", "login_name": "x", "user_level": level, "birthday": "2000-01-01", "gender": "M"}


def order(id_):
    return {"id": id_, "user_id": "u1", "order_status": "1001", "total_amount": "19.0",
            "create_time": "2024-01-01 10:00:00", "consignee_tel": "13812345678"}


def line(id_, order_id):
    return {"id": id_, "order_id": order_id, "sku_id": "s", "sku_name": "Red Ring", "order_price": "9.5", "sku_num": "2"}


def test_changes_become_sale_documents(spark, tmp_path):
    streams = stream_session(spark, partitions=2)
    names = ("entries", "topics", "users", "sales", "c1", "c2", "c3")
    at = {n: str(tmp_path / n) for n in names}

    def run(*entries):
        rows = spark.createDataFrame(list(entries), schemas.CHANGE_ENTRY)
        rows.coalesce(1).write.mode("append").parquet(at["entries"])
        jobs.start_changes(file_changes(streams, at["entries"]), at["topics"], at["c1"], NOW).awaitTermination(120)
        jobs.start_users(
            topic_of(file_feed(streams, at["topics"]), K.TOPIC_USER), at["users"], at["c2"], NOW
        ).awaitTermination(120)
        jobs.start_sales(
            topic_of(file_feed(streams, at["topics"]), K.TOPIC_ORDER),
            topic_of(file_feed(streams, at["topics"]), K.TOPIC_ORDER_DETAIL),
            lambda buyers: jobs.current_users(buyers.sparkSession, at["users"], buyers),
            at["sales"], at["c3"], "2024-01-01", NOW,
        ).awaitTermination(120)
        return read_latest(spark, at["sales"], jobs.SALE_TABLE, ["order_detail_id"])

    docs = run(
        entry("user_info", "INSERT", user("1")), entry("order_info", "INSERT", order("o1")),
        entry("order_detail", "INSERT", line("d1", "o1"), line("d2", "o1"), line("d3", "o2")),
        entry("base_trademark", "INSERT", {"id": "9"}),
    )
    assert {(d.order_detail_id, d.user_level) for d in docs.collect()} == {("d1", "1"), ("d2", "1")}

    docs = run(
        entry("user_info", "UPDATE", user("2"), at="2024-01-01T10:00:30"),
        entry("order_info", "INSERT", order("o2"), at="2024-01-01T10:00:40"),
    )
    assert {(d.order_detail_id, d.user_level) for d in docs.collect()} == {("d1", "1"), ("d2", "1"), ("d3", "2")}

    answer = json.loads(search.response(docs, "red ring", "2024-01-01", size=2).first().response)
    assert answer["total"] == 3
    assert [d["order_detail_id"] for d in answer["detail"]] == ["d1", "d2"]
    assert answer["stat"][0] == {"options": [{"name": "男", "value": 100.0}, {"name": "女", "value": 0.0}],
                                 "title": "性别分布"}
