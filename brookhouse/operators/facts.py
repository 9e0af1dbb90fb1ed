"""Facts that are filters and projections of the change log.

Input is the change log with event times (`with_times`). Cells stay text, as in the log.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookhouse.operators.changes import cells, changes_of

# Status codes of the shop; fixed values.
ORDER_UNPAID = "1001"
ORDER_CANCELLED = "1003"
PAYMENT_DONE = "1602"


def comments(changes: DataFrame, database: str) -> DataFrame:
    return changes_of(changes, database, "comment_info", "insert").select(
        *cells("id", "user_id", "nick_name", "head_img", "sku_id", "spu_id", "order_id", "appraise", "comment_txt",
               "create_time", "operate_time"),
        "proc_time",
    )


def cart_adds(changes: DataFrame, database: str) -> DataFrame:
    """Goods put into a cart: new cart lines, and increases of an existing line by the difference."""
    now = F.col("data")["sku_num"].try_cast("bigint")
    before = F.col("old")["sku_num"].try_cast("bigint")
    inserted = F.col("type") == "insert"
    return (
        changes_of(changes, database, "cart_info", "insert", "update")
        .filter(inserted | (F.col("old")["sku_num"].isNotNull() & (now > before)))
        .select(
            *cells("id", "user_id", "sku_id", "cart_price"),
            F.when(inserted, F.col("data")["sku_num"]).otherwise((now - before).cast("string")).alias("sku_num"),
            *cells("sku_name", "is_checked", "create_time", "operate_time", "is_ordered", "order_time"),
            "ts",
        )
    )


def order_detail_inserts(changes: DataFrame, database: str) -> DataFrame:
    return changes_of(changes, database, "order_detail", "insert").select(
        *cells("id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time", "split_total_amount",
               "split_activity_amount", "split_coupon_amount"),
        "ts",
        "row_time",
    )


def order_info_inserts(changes: DataFrame, database: str) -> DataFrame:
    return changes_of(changes, database, "order_info", "insert").select(
        *cells("id", "province_id", "user_id"), "ts", "row_time"
    )


def activity_inserts(changes: DataFrame, database: str) -> DataFrame:
    return changes_of(changes, database, "order_detail_activity", "insert").select(
        *cells("order_detail_id", "activity_id", "activity_rule_id"), "row_time"
    )


def coupon_inserts(changes: DataFrame, database: str) -> DataFrame:
    return changes_of(changes, database, "order_detail_coupon", "insert").select(
        *cells("order_detail_id", "coupon_id"), "row_time"
    )


def order_cancels(changes: DataFrame, database: str) -> DataFrame:
    """Orders that went from unpaid to cancelled."""
    return (
        changes_of(changes, database, "order_info", "update")
        .filter((F.col("old")["order_status"] == ORDER_UNPAID) & (F.col("data")["order_status"] == ORDER_CANCELLED))
        .select(*cells("id", "operate_time"), "ts", "row_time")
    )


def payments(changes: DataFrame, database: str) -> DataFrame:
    """Payments that have just become successful."""
    return (
        changes_of(changes, database, "payment_info", "update")
        .filter(F.col("old")["payment_status"].isNotNull() & (F.col("data")["payment_status"] == PAYMENT_DONE))
        .select(
            *cells("id", "order_id", "user_id", "payment_type", "total_amount", "callback_time"),
            "ts",
            "row_time",
            "proc_time",
        )
    )
