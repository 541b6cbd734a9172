"""What must hold between results."""

from pyspark.sql import functions as F

from martpulse.catalog import queries as Q
from martpulse.plans import alerts, devices, orders
from martpulse.sources import shop


def values(df):
    return {r[0]: r[1] for r in df.collect()}


def test_hours_sum_to_the_day(spark, folder):
    logs = shop.startup_log(spark, folder)
    assert sum(values(devices.by_hour(logs, Q.LOG_DAY)).values()) == devices.total(logs, Q.LOG_DAY).first().dau
    sold = shop.order_heads(spark, folder)
    by_hour = sum(values(orders.turnover_by_hour(sold, Q.ORDER_DAY)).values())
    assert round(by_hour, 2) == orders.turnover(sold, Q.ORDER_DAY).first().sum_amount


def test_a_day_has_no_more_devices_than_there_are(spark, folder):
    logs = shop.startup_log(spark, folder)
    devices_in_all = logs.select("mid").distinct().count()
    assert max(values(devices.daily_total(logs)).values()) <= devices_in_all
    assert sum(values(devices.new_devices(logs)).values()) == devices_in_all


def test_shares_are_percentages_that_add_up(spark, folder):
    for query in (Q.q20_gender_share, Q.q21_age_share):
        shares = [r.value for r in query(spark, folder).collect()]
        assert all(0 <= s <= 100 for s in shares) and round(sum(shares), 1) == 100


def test_alerts_have_three_users_and_no_click(spark, folder):
    log = shop.event_log(spark, folder)
    found = alerts.detect(log, Q.WINDOW, Q.SLIDE)
    assert found.agg(F.min("uid_count")).first()[0] >= 3
    clicks = log.where(alerts.is_click()).select(F.col("mid").alias("m"), F.col("ts").cast("timestamp").alias("at"))
    inside = (F.col("at") >= F.col("window_start")) & (F.col("at") < F.col("window_end"))
    assert found.join(clicks, (F.col("mid") == F.col("m")) & inside, "left_semi").count() == 0


def test_turnover_does_not_depend_on_the_order_of_rows(spark, folder):
    sold = shop.order_heads(spark, folder)
    one, other = (
        dict(map(tuple, orders.daily_turnover(df).collect())) for df in (sold, sold.repartition(13).sortWithinPartitions("id"))
    )
    assert one == other
