"""Values that decide results or that callers see."""

# --- fixed values ---------------------------------------------------------------------------
# event kinds the alert looks at
COUPON = "coupon"
CLICK_ITEM = "clickItem"

# alert: window length, fewest users per device
ALERT_WINDOW = "5 minutes"
ALERT_MIN_USERS = 3

# how long an order and its lines wait for each other
JOIN_EXPIRY = "100 seconds"

# micro-batch intervals
TRIGGER_LOGS = "5 seconds"
TRIGGER_ORDERS = "3 seconds"

# phone mask: kept characters, stars
TEL_KEEP = 4
TEL_STARS = 9

# cards of the totals panel: id, label
CARD_DAU = ("dau", "新增日活")
CARD_NEW_MID = ("new_mid", "新增设备")
CARD_AMOUNT = ("order_amount", "新增交易额")

# charts of the sale search: title and option labels
GENDER_TITLE = "性别分布"
GENDER_MALE = "男"
GENDER_FEMALE = "女"
AGE_TITLE = "年龄分布"
AGE_YOUNG = "20岁以下"
AGE_MIDDLE = "20岁到30岁"
AGE_OLD = "30岁及30岁以上"
AGE_YOUNG_BELOW = 20
AGE_OLD_FROM = 30

# gender code counted as male
MALE = "M"

# colour bands of the province map: width, number
BAND_WIDTH = 100
BAND_COUNT = 6

# columns of the order table, in order
ORDER_COLUMNS = [
    "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status", "payment_way",
    "user_id", "img_url", "total_amount", "expire_time", "delivery_address", "create_time",
    "operate_time", "tracking_no", "parent_order_id", "out_trade_no", "trade_body", "create_date",
    "create_hour",
]
# --- end of fixed values ----------------------------------------------------------------------

# Slide of the alert window. Alert ids have minute grain, so finer slides only rewrite the same id.
ALERT_SLIDE = "1 minute"

# How often new devices are looked up among all devices.
TRIGGER_FIRST_SEEN = "1 hour"

# Default topic names; every job takes them as parameters.
TOPIC_STARTUP = "startup"
TOPIC_EVENT = "event"
TOPIC_ORDER = "order"
TOPIC_ORDER_DETAIL = "order_detail"
TOPIC_USER = "user_info"
