"""Inputs in the shape of the warehouse's topics, derived row by row from the driver's tables.

All derivations are projections, so they hold for streams over the same files too. Order times follow from the order
key (7 seconds apart), so lines and orders agree on them without a join.
"""

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookhouse.functions.jsons import to_line
from brookhouse.operators.changes import with_times
from brookhouse.operators.sizing import materialise

DATABASE = "shop"
ORDER_EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
ORDER_GAP = 7


def table(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    stored = spark.read.parquet(path)
    if not stream:
        return stored
    reader = spark.readStream.schema(stored.schema)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop_path).isDirectory():
        return reader.parquet(path)
    # streams read folders, not single files
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def order_seconds(key: str) -> Column:
    return F.col(key) * ORDER_GAP + F.lit(ORDER_EPOCH).cast("bigint")


def date_time(seconds: Column) -> Column:
    """UTC date and time text, whatever the session zone."""
    return F.date_format(
        F.timestamp_add("SECOND", seconds, F.expr("timestamp_ntz'1970-01-01 00:00:00'")), "yyyy-MM-dd HH:mm:ss"
    )


def epoch_ms(c: str) -> Column:
    return F.timestamp_diff("MILLISECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col(c))


def pairs(**values: Column) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])


def no_cells() -> Column:
    return F.lit(None).cast("map<string,string>")


def changes(rows: DataFrame, table_name: str, kind: Column | str, ts: Column, data: Column, old: Column | None = None,
            xid: Column | None = None) -> DataFrame:
    """Change-log records."""
    return rows.select(
        F.lit(DATABASE).alias("database"), F.lit(table_name).alias("table"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("type"), ts.alias("ts"),
        (xid if xid is not None else F.lit(None).cast("string")).alias("xid"),
        F.lit(True).alias("commit"), data.alias("data"), (old if old is not None else no_cells()).alias("old"),
    )


FAR_SECONDS = 4102444800  # 2100-01-01


def sentinel(spark: SparkSession, sf_dir: str, table_name: str, stream: bool = True) -> DataFrame:
    """A far-future insert without partners: it lets a stream over the files close what is open at their end.

    It has keys and its table's name, as filters on those are applied before the watermark.
    """
    own = F.lit(f"end of {table_name}")
    one = table(spark, sf_dir, "region", stream).filter("r_regionkey = 0")
    return changes(one, table_name, "insert", F.lit(FAR_SECONDS).cast("bigint"), pairs(
        id=own, order_id=own, order_detail_id=own))


def log_of(maker, spark: SparkSession, sf_dir: str, stream: bool = False, end_of: str | None = None) -> DataFrame:
    """Change log of one derivation with event times, watermarked on a stream; `end_of` closes it with a sentinel."""
    rows = maker(spark, sf_dir, stream)
    if stream and end_of:
        rows = rows.unionByName(sentinel(spark, sf_dir, end_of))
    return with_times(rows)


# Messages of a partition, at most but for chance.
PARTITION_ROWS = 1_000_000


def dealt(lines: DataFrame) -> DataFrame:
    """Messages in as many partitions as there are cores, or more if they are many, as on a bus whose topics have partitions."""
    if lines.isStreaming:
        return lines
    return lines.repartition(max(lines.sparkSession.sparkContext.defaultParallelism, -(-lines.count() // PARTITION_ROWS)), "ts")


def as_lines(log: DataFrame) -> DataFrame:
    """Change-log records as the JSON text that a bus carries.

    `explode` keeps later filters behind the text, which they would otherwise build again for themselves.
    """
    line = to_line("database", "table", "type", "ts", "xid", "commit", "data", "old")
    return dealt(log).select(F.explode(F.array(line)).alias("value"))


# --- trade --------------------------------------------------------------------------------------------------------

LINE_ID = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def line_id() -> Column:
    return F.concat_ws("-", *[text(c) for c in LINE_ID])


def order_detail_changes(spark, sf_dir, stream=False) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem", stream)
    at = order_seconds("l_orderkey")
    return changes(rows, "order_detail", "insert", at, pairs(
        id=line_id(), order_id=text("l_orderkey"), sku_id=text("l_partkey"),
        sku_name=F.concat(F.lit("sku-"), text("l_partkey")), order_price=money("l_extendedprice"),
        sku_num=text(F.col("l_quantity").cast("bigint")), create_time=date_time(at),
        split_total_amount=money("l_extendedprice"),
        split_activity_amount=F.when(F.col("l_discount") >= 0.05, F.lit("5.00")).otherwise(F.lit("0.00")),
        split_coupon_amount=F.lit("0.00"),
    ))


def order_info_changes(spark, sf_dir, stream=False) -> DataFrame:
    return changes(table(spark, sf_dir, "orders", stream), "order_info", "insert", order_seconds("o_orderkey"), pairs(
        id=text("o_orderkey"), province_id=text(F.col("o_custkey") % 34), user_id=text("o_custkey"),
    ))


def activity_changes(spark, sf_dir, stream=False) -> DataFrame:
    """Lines with a discount of 5 % and more have an activity; for the others one is changed."""
    rows = table(spark, sf_dir, "lineitem", stream)
    kind = F.when(F.col("l_discount") >= 0.05, "insert").otherwise("update")
    return changes(rows, "order_detail_activity", kind, order_seconds("l_orderkey"), pairs(
        order_id=text("l_orderkey"), order_detail_id=line_id(), activity_id=text(F.col("l_suppkey") % 10),
        activity_rule_id=text("l_suppkey"),
    ))


def coupon_changes(spark, sf_dir, stream=False) -> DataFrame:
    """Lines with a tax of 5 % and more have a coupon; for the others one is deleted."""
    rows = table(spark, sf_dir, "lineitem", stream)
    kind = F.when(F.col("l_tax") >= 0.05, "insert").otherwise("delete")
    return changes(rows, "order_detail_coupon", kind, order_seconds("l_orderkey"), pairs(
        order_id=text("l_orderkey"), order_detail_id=line_id(), coupon_id=text("l_suppkey"),
    ))


def order_log(spark, sf_dir) -> DataFrame:
    """The changes of all four tables behind the order-detail fact."""
    makers = (order_detail_changes, order_info_changes, activity_changes, coupon_changes)
    return reduce(DataFrame.unionByName, [maker(spark, sf_dir) for maker in makers])


def order_cancel_changes(spark, sf_dir, stream=False) -> DataFrame:
    """Orders with status F are cancelled up to an hour later; the others change to another status, or from another."""
    rows = table(spark, sf_dir, "orders", stream)
    at = order_seconds("o_orderkey") + F.col("o_orderkey") % 60 * 60
    status = F.when(F.col("o_orderstatus") == "F", "1003").otherwise("1002")
    before = F.when(F.col("o_orderstatus") == "P", "1002").otherwise("1001")
    return changes(rows, "order_info", "update", at, pairs(
        id=text("o_orderkey"), operate_time=date_time(at), order_status=status,
    ), pairs(order_status=before))


def payment_changes(spark, sf_dir, stream=False) -> DataFrame:
    """Orders with status P are paid between 20 minutes before and 9 minutes after their time; F ones fail to pay, and of
    O ones other columns of a finished payment change."""
    rows = table(spark, sf_dir, "orders", stream)
    at = order_seconds("o_orderkey") + (F.col("o_orderkey") % 30 - 20) * 60
    status = F.when(F.col("o_orderstatus") == "F", "1603").otherwise("1602")
    before = F.when(F.col("o_orderstatus") == "O", pairs(total_amount=F.lit("0.00"))).otherwise(pairs(payment_status=F.lit("1601")))
    return changes(rows, "payment_info", "update", at, pairs(
        id=text("o_orderkey"), order_id=text("o_orderkey"), user_id=text("o_custkey"),
        payment_type=F.substring("o_orderpriority", 1, 1), total_amount=money("o_totalprice"),
        callback_time=date_time(at), payment_status=status,
    ), before)


def comment_changes(spark, sf_dir, stream=False) -> DataFrame:
    """Orders with status O are commented on; the comments of the others are changed or deleted."""
    rows = table(spark, sf_dir, "orders", stream)
    at = order_seconds("o_orderkey")
    kind = F.when(F.col("o_orderstatus") == "O", "insert").when(F.col("o_orderstatus") == "F", "update").otherwise("delete")
    return changes(rows, "comment_info", kind, at, pairs(
        id=text("o_orderkey"), user_id=text("o_custkey"), nick_name=F.concat(F.lit("user-"), text("o_custkey")),
        head_img=F.lit(None).cast("string"), sku_id=text(F.col("o_orderkey") % 100),
        spu_id=text(F.col("o_orderkey") % 10), order_id=text("o_orderkey"),
        appraise=F.substring("o_orderpriority", 1, 1), comment_txt=F.col("o_orderpriority"),
        create_time=date_time(at), operate_time=F.lit(None).cast("string"),
    ))


def cart_changes(spark, sf_dir, stream=False) -> DataFrame:
    """First lines are new cart rows; for the others the number of goods changes from five times the line number."""
    rows = table(spark, sf_dir, "lineitem", stream)
    kind = F.when(F.col("l_linenumber") == 1, "insert").otherwise("update")
    at = order_seconds("l_orderkey")
    before = pairs(sku_num=text(F.col("l_linenumber") * 5))
    return changes(rows, "cart_info", kind, at, pairs(
        id=line_id(), user_id=text("l_suppkey"), sku_id=text("l_partkey"), cart_price=money("l_extendedprice"),
        sku_num=text(F.col("l_quantity").cast("bigint")), sku_name=F.concat(F.lit("sku-"), text("l_partkey")),
        is_checked=F.lit(None).cast("string"), create_time=date_time(at), operate_time=F.lit(None).cast("string"),
        is_ordered=F.lit("0"), order_time=F.lit(None).cast("string"),
    ), F.when(F.col("l_linenumber") == 1, no_cells()).otherwise(before))


def dictionary(spark, sf_dir) -> DataFrame:
    """Dictionary of the order priorities, but for code 5; in the relational shape. Written out, as lookups weigh it."""
    return materialise(
        table(spark, sf_dir, "orders")
        .select(F.substring("o_orderpriority", 1, 1).alias("dic_code"),
                F.expr("substring(o_orderpriority, 3)").alias("dic_name"))
        .filter("dic_code <> '5'")
        .distinct()
        .withColumn("parent_code", F.lit("11")),
        "dictionary",
    )


# --- routing ------------------------------------------------------------------------------------------------------

KINDS = {"F": "insert", "O": "update", "P": "delete", "N": "insert", "A": "update", "R": "delete"}


def generic_changes(spark, sf_dir, stream=False) -> DataFrame:
    """Orders and lines as changes whose type follows from status and return flag."""
    def kind(flag: str, letters: str) -> Column:
        c = None
        for x in letters:
            c = F.when(F.col(flag) == x, KINDS[x]) if c is None else c.when(F.col(flag) == x, KINDS[x])
        return c

    orders = table(spark, sf_dir, "orders", stream)
    lines = table(spark, sf_dir, "lineitem", stream)
    return changes(orders, "orders", kind("o_orderstatus", "FOP"), order_seconds("o_orderkey"), pairs(
        o_orderkey=text("o_orderkey"), o_custkey=text("o_custkey"), o_orderstatus=F.col("o_orderstatus"),
        o_orderpriority=F.col("o_orderpriority"), id=text("o_orderkey"),
    )).unionByName(changes(lines, "lineitem", kind("l_returnflag", "NAR"), order_seconds("l_orderkey"), pairs(
        l_orderkey=text("l_orderkey"), l_linenumber=text("l_linenumber"), l_partkey=text("l_partkey"), id=line_id(),
    )))


# (op, before, after) events of the routing tables: a snapshot, a rename of a target, a route added and deleted.
FACT_FEED = [
    ("r", None, ("orders", "insert", "dwd_order_old", "o_orderkey")),
    ("r", None, ("orders", "update", "dwd_order_change", "o_orderkey,o_orderstatus")),
    ("u", ("orders", "insert", "dwd_order_old", "o_orderkey"),
     ("orders", "insert", "dwd_order_new", "o_orderkey,o_custkey")),
    ("c", None, ("lineitem", "update", "dwd_line_change", "l_orderkey")),
    ("d", ("lineitem", "update", "dwd_line_change", "l_orderkey"), None),
]
FACT_SNAPSHOT = [("lineitem", "insert", "dwd_line_new", "l_orderkey,l_linenumber")]
DIM_FEED = [
    ("r", None, ("orders", "dim_order", "o_orderkey,o_orderstatus", "info", "id")),
    ("r", None, ("lineitem", "dim_line_old", "l_orderkey", "info", "id")),
    ("u", ("lineitem", "dim_line_old", "l_orderkey", "info", "id"),
     ("lineitem", "dim_line", "l_orderkey,l_partkey", "info", "id")),
    ("c", None, ("part", "dim_part", "p_name", "info", "id")),
    ("d", ("part", "dim_part", "p_name", "info", "id"), None),
]


def feed_lines(spark, events, route) -> DataFrame:
    """Change events of a routing table as JSON text."""
    names = route.fieldNames()

    def image(row):
        return dict(zip(names, row)) if row else None

    lines = [
        json.dumps({"before": image(b), "after": image(a), "op": op, "ts_ms": 1000 + i,
                    "source": {"db": "config", "table": "table_process", "pos": i}})
        for i, (op, b, a) in enumerate(events)
    ]
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*map(F.lit, lines))).alias("value"))


def route_rows(spark, routes, route) -> DataFrame:
    """Rows of a routing table."""
    images = [F.struct(*[F.lit(v).alias(n) for n, v in zip(route.fieldNames(), r)]) for r in routes]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*images)))


def dim_changes(spark, sf_dir) -> DataFrame:
    """Orders as changes of a customer dimension, in key order; some cells NULL, some rows deletes."""
    key = F.col("o_orderkey")
    kind = F.when((F.col("o_orderstatus") == "P") & (key % 5 == 0), "delete").otherwise("insert")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("row_key"), key.alias("seq"), kind.alias("type"),
        pairs(prio=F.when(key % 3 != 0, F.col("o_orderpriority")),
              st=F.when(key % 2 != 0, F.col("o_orderstatus"))).alias("data"),
    )


# --- behaviour ----------------------------------------------------------------------------------------------------


def behaviour_log(spark, sf_dir, stream=False) -> DataFrame:
    """Events as behaviour records: signup starts the app, errors come with a page, all others are page views."""
    e = table(spark, sf_dir, "events", stream).withColumns({
        "k": F.get_json_object("props", "$.k").cast("bigint"), "ms": epoch_ms("ts"),
    })
    kind = F.col("event_type")

    def missing(t: str) -> Column:
        return F.lit(None).cast(t)

    common = F.struct(
        text(F.col("k") % 34).alias("ar"), text("user_id").alias("uid"), F.lit("os").alias("os"),
        F.lit("ch").alias("ch"), F.when(kind == "signup", "1").otherwise("0").alias("is_new"), F.lit("md").alias("md"),
        text("user_id").alias("mid"), F.lit("v1").alias("vc"), F.lit("ba").alias("ba"),
        text("event_id").alias("sid"),
    )
    found = (kind == "click") & (F.col("k") % 4 == 0)
    page = F.struct(
        kind.alias("page_id"), F.when(found, "search").otherwise("home").alias("last_page_id"),
        F.concat(F.lit("item-"), text("k")).alias("item"),
        F.when(found, "keyword").otherwise("sku_id").alias("item_type"),
        F.col("k").alias("during_time"), missing("string").alias("refer_id"), missing("bigint").alias("from_pos_id"),
        missing("bigint").alias("from_pos_seq"),
    )
    start = F.struct(
        F.lit("icon").alias("entry"), F.col("k").alias("loading_time"), missing("bigint").alias("open_ad_id"),
        missing("bigint").alias("open_ad_ms"), missing("bigint").alias("open_ad_skip_ms"),
    )
    shown = F.transform(
        F.when(F.col("k") % 3 > 0, F.sequence(F.lit(1).cast("bigint"), F.col("k") % 3)),
        lambda i: F.struct(i.alias("pos_seq"), F.concat(F.lit("sku-"), text(i)).alias("item"),
                           F.lit("sku_id").alias("item_type"), F.col("k").alias("pos_id")),
    )
    acted = F.array(F.struct(
        F.lit("favor_add").alias("action_id"), text("k").alias("item"), F.lit("sku_id").alias("item_type"),
        (F.col("ms") + 5000).alias("ts"),
    ))
    is_page = kind != "signup"
    return e.select(
        common.alias("common"), F.when(is_page, page).alias("page"), F.when(~is_page, start).alias("start"),
        F.when(is_page, shown).alias("displays"), F.when(kind == "click", acted).alias("actions"),
        F.when(kind == "error", F.struct((F.col("k") + 1000).alias("error_code"),
                                         F.concat(F.lit("event "), text("event_id")).alias("msg"))).alias("err"),
        F.col("ms").alias("ts"),
    )


def behaviour_lines(spark, sf_dir, stream=False) -> DataFrame:
    """The behaviour log as text, with a field at each level that no schema knows."""
    def more(array: str, name: str, value) -> Column:
        return F.transform(array, lambda e: e.withField(name, value(e)))

    log = behaviour_log(spark, sf_dir, stream)
    return log_lines(log.withColumns({
        "common": F.col("common").withField("net", F.lit("wifi")),
        "page": F.col("page").withField("scroll", F.col("page.during_time")),
        "start": F.col("start").withField("cold", F.lit(True)),
        "displays": more("displays", "rank", lambda e: e["pos_seq"]), "actions": more("actions", "weight", lambda e: F.lit(1)),
        "err": F.col("err").withField("trace", F.lit("at x")), "device": F.struct(F.lit("tablet").alias("kind")),
    }))


def log_lines(log: DataFrame) -> DataFrame:
    return dealt(log).select(F.explode(F.array(to_line(*log.columns))).alias("value"))


def page_info(spark, sf_dir) -> DataFrame:
    """Events as the page topic, with map columns; a fourth of the clicks are searches."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    found = (F.col("event_type") == "click") & (F.col("k") % 4 == 0)
    return e.select(
        pairs(mid=text("user_id")).alias("common"),
        pairs(last_page_id=F.when(found, "search").otherwise("home"),
              item_type=F.when(found, "keyword").otherwise("sku_id"),
              item=F.concat(F.lit("item-"), text("k"))).alias("page"),
        epoch_ms("ts").alias("ts"),
    )
