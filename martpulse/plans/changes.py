"""Database changes to topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martpulse import constants as K

# Which changes of which table go to which topic; all others are of no interest.
ROUTES = [
    ("order_info", ("INSERT",), K.TOPIC_ORDER),
    ("order_detail", ("INSERT",), K.TOPIC_ORDER_DETAIL),
    ("user_info", ("INSERT", "UPDATE"), K.TOPIC_USER),
]


def routed(entries: DataFrame, routes=ROUTES) -> DataFrame:
    """Row-data entries with their topic."""
    topic = F.lit(None).cast("string")
    for table, kinds, name in routes:
        topic = F.when((F.col("table_name") == table) & F.col("event_type").isin(*kinds), name).otherwise(topic)
    return (
        entries.where(F.col("entry_type") == "ROWDATA").withColumn("topic", topic).where(F.col("topic").isNotNull())
    )


def flattened(entries: DataFrame) -> DataFrame:
    """One feed row per changed row: its after-image as a JSON object of texts."""
    images = entries.select("topic", "exec_time", F.posexplode("rows").alias("pos", "image"))
    return images.select(
        "topic", F.to_json(F.map_from_entries("image")).alias("value"), F.col("exec_time").alias("timestamp"), "pos"
    )
