"""Record schemas of the feeds.

Change feeds carry every value as text, so each feed is parsed as strings first and the few numeric fields
are cast afterwards (``CASTS``), where a value that is no number becomes NULL.
"""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


STARTUP_LOG = _strings("mid", "uid", "appid", "area", "os", "ch", "type", "vs", "ts")

EVENT_LOG = _strings("mid", "uid", "appid", "area", "os", "type", "evid", "pgid", "npgid", "itemid", "ts")

ORDER_INFO = _strings(
    "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status", "payment_way",
    "user_id", "img_url", "total_amount", "expire_time", "delivery_address", "create_time", "operate_time",
    "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
)

ORDER_DETAIL = _strings("id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num")

USER_INFO = _strings("id", "login_name", "user_level", "birthday", "gender")

CASTS = {"ts": "bigint", "total_amount": "double", "birthday": "date"}

# A feed row as a message broker delivers it.
# ``pos`` is the row's place among those of one change entry, which share their time; other feeds leave it empty.
FEED = "topic STRING, value STRING, timestamp TIMESTAMP, pos INT"
# The same with the row's place in the topic's log, which feeds without a broker may lack.
PLACED_FEED = FEED + ", partition INT, offset BIGINT"

# One entry of a database change log.
CHANGE_ENTRY = (
    "entry_type STRING, table_name STRING, event_type STRING, exec_time TIMESTAMP, "
    "rows ARRAY<ARRAY<STRUCT<name: STRING, value: STRING>>>"
)

SALE_DETAIL = (
    "order_detail_id STRING, order_id STRING, order_status STRING, create_time STRING, user_id STRING, "
    "sku_id STRING, user_gender STRING, user_age INT, user_level STRING, sku_price DOUBLE, "
    "sku_name STRING, dt STRING"
)
SALE_DETAIL_COLUMNS = [c.split()[0] for c in SALE_DETAIL.split(", ")]
