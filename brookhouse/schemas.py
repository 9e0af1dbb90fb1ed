"""Explicit schemas; nothing is inferred on a stream.

Field, table and topic names are fixed values: producers and consumers of the topics rely on them.
"""

from pyspark.sql import types as T

STR = T.StringType()
LONG = T.LongType()
STR_MAP = T.MapType(STR, STR)


def strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, STR) for n in names]


def longs(*names: str) -> list[T.StructField]:
    return [T.StructField(n, LONG) for n in names]


# Business change log. `ts` (seconds) is read as text because producers write it both quoted and bare.
CHANGE_LOG = T.StructType([
    *strings("database", "table", "type", "ts", "xid"),
    T.StructField("commit", T.BooleanType()),
    T.StructField("data", STR_MAP),
    T.StructField("old", STR_MAP),
])

COMMON = T.StructType(strings("ar", "uid", "os", "ch", "is_new", "md", "mid", "vc", "ba", "sid"))
PAGE = T.StructType([
    *strings("page_id", "last_page_id", "item", "item_type"),
    *longs("during_time"),
    *strings("refer_id"),
    *longs("from_pos_id", "from_pos_seq"),
])
START = T.StructType([
    *strings("entry"), *longs("loading_time", "open_ad_id", "open_ad_ms", "open_ad_skip_ms"),
])
DISPLAY = T.StructType([*longs("pos_seq"), *strings("item", "item_type"), *longs("pos_id")])
ACTION = T.StructType([*strings("action_id", "item", "item_type"), *longs("ts")])
ERR = T.StructType([*longs("error_code"), *strings("msg")])

# Behaviour log; `ts` in milliseconds, read as text for the same reason.
BEHAVIOUR_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField("start", START),
    T.StructField("displays", T.ArrayType(DISPLAY)),
    T.StructField("actions", T.ArrayType(ACTION)),
    T.StructField("err", ERR),
    *strings("ts"),
])

# Page topic as the keyword job reads it.
PAGE_INFO = T.StructType([
    T.StructField("common", STR_MAP), T.StructField("page", STR_MAP), *longs("ts"),
])

# Routing configuration.
FACT_ROUTE = T.StructType(strings("source_table", "source_type", "sink_table", "sink_columns"))
DIM_ROUTE = T.StructType(strings("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key"))


def route_feed(route: T.StructType) -> T.StructType:
    """Change event of a routing table: before/after images plus the operation letter."""
    return T.StructType([
        T.StructField("before", route),
        T.StructField("after", route),
        *strings("op"),
        *longs("ts_ms"),
        T.StructField("source", T.StructType([*strings("db", "table"), *longs("pos")])),
    ])


ORDER_DETAIL_FACT = T.StructType([
    *strings("id", "order_id", "sku_id", "province_id", "user_id", "activity_id", "activity_rule_id", "coupon_id",
             "sku_name", "order_price", "sku_num", "create_time", "split_total_amount", "split_activity_amount",
             "split_coupon_amount"),
    *longs("ts"),
])

# Topics.
TOPIC_DB = "topic_db"
TOPIC_LOG = "topic_log"
TRAFFIC_PAGE = "dwd_traffic_page"
TRAFFIC_START = "dwd_traffic_start"
TRAFFIC_ERR = "dwd_traffic_err"
TRAFFIC_DISPLAY = "dwd_traffic_display"
TRAFFIC_ACTION = "dwd_traffic_action"
COMMENT_INFO = "dwd_interaction_comment_info"
CART_ADD = "dwd_trade_cart_add"
ORDER_DETAIL = "dwd_trade_order_detail"
ORDER_CANCEL = "dwd_trade_order_cancel"
PAYMENT_SUCCESS = "dwd_trade_order_payment_success"
KEYWORD_WINDOW = "dws_traffic_source_keyword_page_view_window"
DIM_DICTIONARY = "dim_base_dic"
