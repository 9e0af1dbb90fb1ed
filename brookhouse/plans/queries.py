"""One query per operator, over the driver's tables. Each callable takes (spark, folder of the tables)."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookhouse import schemas as S
from brookhouse.functions import dates as D
from brookhouse.functions.jsons import exact_amounts, to_line
from brookhouse.operators import behaviour as B
from brookhouse.operators import facts
from brookhouse.operators import joins as J
from brookhouse.operators import keyword as K
from brookhouse.operators import lookup as L
from brookhouse.operators import routing as R
from brookhouse.operators.changes import cells, clean_changes, parse_changes
from brookhouse.operators.dimension import fold_cells
from brookhouse.operators.latest import keyed_messages, latest_by_key
from brookhouse.operators.sizing import small_join
from brookhouse.operators.skew import NO_SALT, every_key, hot_keys
from brookhouse.plans import inputs as I
from brookhouse.sources.bus import change_log, json_table, timed_json_table
from brookhouse.streaming.sinks import json_messages
from brookhouse.streaming.sinks import upsert_messages as upsert_messages_of

DB = I.DATABASE
UTC = "UTC"

Query = Callable[[SparkSession, str], DataFrame]


# --- cleansing ----------------------------------------------------------------------------------------------------


def _dirty_change_lines(spark, sf_dir) -> DataFrame:
    """Order changes as text, with damage that depends on the order key."""
    key = F.col("o_orderkey")
    rest = key % 10

    def line(database: str, kind: str, data) -> F.Column:
        return to_line(F.lit(database).alias("database"), F.lit("orders").alias("table"), F.lit(kind).alias("type"),
                       I.order_seconds("o_orderkey").alias("ts"), data.alias("data"))

    data = I.pairs(id=I.text(key), status=F.col("o_orderstatus"))
    empty = F.create_map().cast("map<string,string>")
    return I.table(spark, sf_dir, "orders").select(F.explode(F.array(
        F.when(rest == 0, "")
        .when(key % 30 == 1, F.concat(F.lit("garbage "), I.text(key)))
        .when(key % 30 == 11, F.concat(line(DB, "insert", data), F.lit(" "), line(DB, "update", data)))
        .when(rest == 1, F.concat(line(DB, "insert", data), F.lit(" junk {}")))
        .when(rest == 2, line(DB, "bootstrap-start", data))
        .when(rest == 3, line("other", "insert", data))
        .when(rest == 4, line(DB, "insert", empty))
        .when(rest == 5, line(DB, "bootstrap-insert", data))
        .when(rest == 6, F.concat(F.lit('{"database":"'), F.lit(DB), F.lit('","table":"orders","data":{"id":"'),
                                  I.text(key), F.lit('"}}')))
        .when(rest == 7, F.lit(None).cast("string"))
        .otherwise(line(DB, "update", data))
    )).alias("value"))


def cdc_cleanse(spark, sf_dir):
    lines = _dirty_change_lines(spark, sf_dir)
    return clean_changes(lines, DB).select("type", "ts", *cells("id", "status"))


def cdc_cleanse_generic(spark, sf_dir):
    lines = _dirty_change_lines(spark, sf_dir)
    return parse_changes(lines).select("database", "table", "type", "ts", *cells("id", "status"))


def exact_money(spark, sf_dir):
    """Amounts of change records as decimals, from the raw text."""
    lines = I.table(spark, sf_dir, "orders").select(
        F.concat(F.lit('{"data":{"id":'), I.text("o_orderkey"), F.lit(',"total":'), I.money("o_totalprice"),
                 F.lit("}}")).alias("value"),
        "o_orderkey",
    )
    return lines.select(
        F.col("o_orderkey").alias("id"),
        (exact_amounts(F.col("value"), "total")["total"] * 100).cast("bigint").alias("total_cents"),
    )


# --- facts --------------------------------------------------------------------------------------------------------


def cart_add(spark, sf_dir):
    return facts.cart_adds(I.log_of(I.cart_changes, spark, sf_dir), DB)


def cart_add_json(spark, sf_dir):
    """The same fact from JSON text to JSON text."""
    log = change_log(I.as_lines(I.cart_changes(spark, sf_dir)), only_tables=("cart_info",))
    return json_messages(facts.cart_adds(log, DB), S.CART_ADD)


def comment_insert(spark, sf_dir):
    return facts.comments(I.log_of(I.comment_changes, spark, sf_dir), DB).drop("proc_time")


def order_detail_insert(spark, sf_dir):
    return facts.order_detail_inserts(I.log_of(I.order_detail_changes, spark, sf_dir), DB).drop("row_time")


def order_detail_view(spark, sf_dir):
    """An intermediate result under a name, queried with SQL."""
    order_detail_insert(spark, sf_dir).createOrReplaceTempView("order_detail_rows")
    return spark.sql("SELECT sku_id, count(*) AS n, sum(CAST(sku_num AS BIGINT)) AS goods FROM order_detail_rows "
                     "GROUP BY sku_id")


def order_info_insert(spark, sf_dir):
    return facts.order_info_inserts(I.log_of(I.order_info_changes, spark, sf_dir), DB).drop("row_time")


def order_activity_insert(spark, sf_dir):
    return facts.activity_inserts(I.log_of(I.activity_changes, spark, sf_dir), DB).drop("row_time")


def order_coupon_insert(spark, sf_dir):
    return facts.coupon_inserts(I.log_of(I.coupon_changes, spark, sf_dir), DB).drop("row_time")


def order_cancel_update(spark, sf_dir):
    return facts.order_cancels(I.log_of(I.order_cancel_changes, spark, sf_dir), DB).drop("row_time")


def payment_success_update(spark, sf_dir):
    return facts.payments(I.log_of(I.payment_changes, spark, sf_dir), DB).drop("row_time", "proc_time")


def details(spark, sf_dir, bounds=J.SAME_PURCHASE, stream=False, met=None, between=None):
    """With bounds, time buckets spread a busy order; without, its lines are found and dealt to several tasks. `met` leaves
    the orders, and so the lines, that a later join needs. `between`: only lines from one second to before another, with
    all that the bounds let them meet."""
    def log(maker, end_of, around=J.Bounds(0, 0)):
        rows = I.log_of(maker, spark, sf_dir, stream, end_of)
        if between is None:
            return rows
        first, end = between
        return rows.filter((F.col("ts") >= first + around.lower) & (F.col("ts") < end + around.upper))

    around = bounds or J.Bounds(0, 0)
    lines = facts.order_detail_inserts(log(I.order_detail_changes, "order_detail"), DB)
    orders = facts.order_info_inserts(log(I.order_info_changes, "order_info", around), DB)
    return J.order_detail_wide(
        lines,
        met(orders) if met else orders,
        facts.activity_inserts(log(I.activity_changes, "order_detail_activity", around), DB),
        facts.coupon_inserts(log(I.coupon_changes, "order_detail_coupon", around), DB),
        bounds,
        NO_SALT if bounds else hot_keys(lines, "order_id"),
    )


def order_detail_wide(spark, sf_dir):
    return details(spark, sf_dir).drop("row_time")


def order_detail_wide_unbounded(spark, sf_dir):
    return details(spark, sf_dir, None).drop("row_time")


def fact_lines(spark, sf_dir, met=None, between=None):
    """The order-detail topic: the messages of `order_detail_wide`, whose text is built once (see `as_lines`), where the last
    join has left the lines. `between`: see `details`."""
    messages = upsert_messages_of(details(spark, sf_dir, met=met, between=between).drop("row_time"), S.ORDER_DETAIL, ["id"])
    return messages.select("topic", "key", F.explode(F.array("value")).alias("value"))


def fact_table(spark, sf_dir, met=None):
    """The order-detail topic as later jobs read it."""
    return timed_json_table(fact_lines(spark, sf_dir, met).select("value"), S.ORDER_DETAIL_FACT)


def _cancelled(spark, sf_dir, bounds, salt=NO_SALT):
    cancels = facts.order_cancels(I.log_of(I.order_cancel_changes, spark, sf_dir), DB)
    lines = fact_table(spark, sf_dir, lambda orders: J.orders_met(orders, cancels, "id", bounds))
    return J.order_cancel_wide(lines, cancels, bounds, salt)


def order_cancel(spark, sf_dir):
    return _cancelled(spark, sf_dir, J.CANCEL_WINDOW)


def order_cancel_unbounded(spark, sf_dir):
    """Without time buckets, so a busy order needs its lines dealt to several tasks."""
    return _cancelled(spark, sf_dir, None, every_key(4))


def _paid(spark, sf_dir, bounds=J.PAYMENT_WINDOW):
    done = facts.payments(I.log_of(I.payment_changes, spark, sf_dir), DB)
    lines = fact_table(spark, sf_dir, lambda orders: J.orders_met(orders, done, "order_id", bounds))
    return J.paid_order_lines(lines, done, bounds)


def payment_interval(spark, sf_dir):
    return _paid(spark, sf_dir).drop("proc_time")


def payment_interval_after_order(spark, sf_dir):
    return _paid(spark, sf_dir, J.PAYMENT_AFTER_ORDER).drop("proc_time")


def click_purchase_interval(spark, sf_dir):
    """Interval join of a table with few, busy keys: clicks of a user from 6 hours before to 10 minutes after."""
    e = I.table(spark, sf_dir, "events").withColumn("row_time", F.timestamp_micros(F.timestamp_diff(
        "MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), "ts")))
    bought = e.filter("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "user_id", "row_time")
    clicked = e.filter("event_type = 'click'").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("clicker"), "row_time")
    return J.interval_join(bought, clicked, "user_id", "clicker", J.Bounds(-6 * 3600, 600), salt=every_key(8)).select(
        "purchase_id", "click_id", "user_id")


def payment_success(spark, sf_dir):
    return L.payment_facts(_paid(spark, sf_dir), L.dictionary_rows(I.dictionary(spark, sf_dir), "dic_code"))


def comment_lookup(spark, sf_dir):
    return L.comment_facts(
        facts.comments(I.log_of(I.comment_changes, spark, sf_dir), DB),
        L.dictionary_rows(I.dictionary(spark, sf_dir), "dic_code"),
    )


def dictionary_join(spark, sf_dir):
    return L.comments_with_relational_dictionary(
        facts.comments(I.log_of(I.comment_changes, spark, sf_dir), DB), I.dictionary(spark, sf_dir))


def order_fact_topic(spark, sf_dir):
    """Order-detail topic written as JSON text and read back as a table with event time."""
    return fact_table(spark, sf_dir).withColumn("row_seconds", F.unix_seconds("row_time")).drop("row_time")


# --- routing and dimensions ---------------------------------------------------------------------------------------


def fact_routes(spark):
    feed = R.decode_feed(I.feed_lines(spark, I.FACT_FEED, S.FACT_ROUTE), S.FACT_ROUTE)
    snapshot = I.route_rows(spark, I.FACT_SNAPSHOT, S.FACT_ROUTE)
    return R.current_routes(snapshot, feed, S.FACT_ROUTE, R.FACT_KEY)


def dim_routes(spark):
    feed = R.decode_feed(I.feed_lines(spark, I.DIM_FEED, S.DIM_ROUTE), S.DIM_ROUTE)
    return R.current_routes(None, feed, S.DIM_ROUTE, R.DIM_KEY)


def config_route_dwd(spark, sf_dir):
    """Routed facts as (target, column, value), with the number of records that carry it."""
    routed = R.route_facts(I.generic_changes(spark, sf_dir), fact_routes(spark))
    return _cells(routed)


def config_route_dwd_json(spark, sf_dir):
    return R.routed_messages(R.route_facts(I.generic_changes(spark, sf_dir), fact_routes(spark)))


def config_route_dim(spark, sf_dir):
    routed = R.route_dimensions(I.generic_changes(spark, sf_dir), dim_routes(spark))
    return routed.select("sink_table", "sink_family", "row_key", "type", F.explode("data").alias("col", "val"))


def _cells(routed):
    return routed.select("sink_table", F.explode("data").alias("col", "val")).groupBy("sink_table", "col", "val").agg(
        F.count("*").alias("n"))


def dim_cell_merge(spark, sf_dir):
    return fold_cells(I.dim_changes(spark, sf_dir), ["row_key"], ["prio", "st"], F.col("seq"))


def dim_cell_merge_nulls(spark, sf_dir):
    return fold_cells(I.dim_changes(spark, sf_dir), ["row_key"], ["prio", "st"], F.col("seq"), overwrite_nulls=True)


def _supplier_feed(spark, sf_dir):
    """A routing table with one dimension per supplier; some are changed or deleted later."""
    key = F.col("s_suppkey")
    steps = F.explode(F.sequence(F.lit(0).cast("bigint"), key % 3)).alias("step")
    row = F.struct(F.col("s_name").alias("source_table"), F.concat(F.lit("dim_"), "s_name").alias("sink_table"),
                   F.lit("a,b").alias("sink_columns"), F.lit("info").alias("sink_family"),
                   F.lit("id").alias("sink_row_key"))
    op = F.when(F.col("step") == 0, "c").when(F.col("step") == 1, "u").otherwise("d")
    return I.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", steps).select(to_line(
        F.when(op != "c", row).alias("before"), F.when(op != "d", row).alias("after"), op.alias("op"),
        (key * 10 + F.col("step") + 1).alias("ts_ms")).alias("value"))


def config_feed(spark, sf_dir):
    return R.decode_feed(_supplier_feed(spark, sf_dir), S.DIM_ROUTE).select(
        "source_table", "sink_table", "op", F.col("seq.ts_ms").alias("ts_ms"))


def config_current(spark, sf_dir):
    feed = R.decode_feed(_supplier_feed(spark, sf_dir), S.DIM_ROUTE)
    return R.current_routes(None, feed, S.DIM_ROUTE, R.DIM_KEY)


def dim_registry(spark, sf_dir):
    actions = R.registry_actions(R.decode_feed(_supplier_feed(spark, sf_dir), S.DIM_ROUTE))
    return actions.select("sink_table", "action", F.col("seq.ts_ms").alias("ts_ms"))


def dim_tables(spark, sf_dir):
    actions = R.registry_actions(R.decode_feed(_supplier_feed(spark, sf_dir), S.DIM_ROUTE))
    return R.registered_tables(actions).select("sink_table", "generation")


def upsert_latest(spark, sf_dir):
    rows = I.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "props")
    return latest_by_key(rows, ["user_id"], F.col("event_id"))


def upsert_with_deletes(spark, sf_dir):
    """Last order per customer; customers whose last order has status P are gone."""
    rows = I.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    return latest_by_key(rows, ["o_custkey"], F.col("o_orderkey"), F.col("o_orderstatus") == "P")


def upsert_messages(spark, sf_dir):
    rows = I.table(spark, sf_dir, "orders").select(
        I.text("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    return keyed_messages(rows, ["id"])


# --- behaviour log ------------------------------------------------------------------------------------------------


def log_cleanse(spark, sf_dir):
    """From JSON text: records without device, without page and start, without time, or cut short are dropped."""
    def when_not(rest: int, c):
        return F.when(F.col("n") % 10 != rest, c)

    log = I.behaviour_log(spark, sf_dir).withColumn("n", F.col("common.sid").cast("bigint")).select(
        F.col("common").withField("mid", when_not(0, F.col("common.mid"))).alias("common"),
        when_not(1, F.col("page")).alias("page"), when_not(1, F.col("start")).alias("start"),
        "displays", "actions", "err", when_not(2, F.col("ts")).alias("ts"), "n",
    )
    text = to_line(*S.BEHAVIOUR_LOG.fieldNames())
    lines = log.select(F.explode(F.array(
        F.when(F.col("n") % 20 == 3, F.left(text, F.lit(20))).when(F.col("n") % 20 == 13, F.concat(text, text)).otherwise(text))).alias("value"))
    return B.clean_log(lines).select(
        F.col("common.sid").alias("sid"), F.col("common.mid").alias("mid"), F.col("page.item").alias("item"),
        F.col("start.loading_time").alias("loading_time"), F.size(F.coalesce("displays", F.array())).alias("shown"),
        "ts",
    )


def _log(spark, sf_dir):
    return B.complete_records(I.behaviour_log(spark, sf_dir))


def visitor_fix(spark, sf_dir):
    return B.repair_visitors(_log(spark, sf_dir), UTC).select(
        F.col("common.sid").alias("sid"), F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
        "ts")


def messages(spark, sf_dir, stream=False, topics=B.TOPICS):
    """Whole messages of the five topics."""
    return B.split_messages(B.clean_log(I.behaviour_lines(spark, sf_dir, stream)), topics)


def _messages_of(spark, sf_dir, topic):
    return messages(spark, sf_dir, topics=(topic,))


def log_page(spark, sf_dir):
    return _messages_of(spark, sf_dir, S.TRAFFIC_PAGE)


def log_start(spark, sf_dir):
    return _messages_of(spark, sf_dir, S.TRAFFIC_START)


def log_err(spark, sf_dir):
    return _messages_of(spark, sf_dir, S.TRAFFIC_ERR)


def log_display(spark, sf_dir):
    return _messages_of(spark, sf_dir, S.TRAFFIC_DISPLAY)


def log_action(spark, sf_dir):
    return _messages_of(spark, sf_dir, S.TRAFFIC_ACTION)


def log_split(spark, sf_dir):
    """All five topics in one pass."""
    return messages(spark, sf_dir)


# --- keywords -----------------------------------------------------------------------------------------------------


def search_keyword(spark, sf_dir):
    return K.search_keywords(I.page_info(spark, sf_dir))


def search_keyword_json(spark, sf_dir):
    """The same from the JSON text of the page topic."""
    lines = I.log_lines(I.page_info(spark, sf_dir))
    return K.search_keywords(json_table(lines, S.PAGE_INFO))


def part_searches(spark, sf_dir, stream=False):
    """Page records of all events; the views search for a part by its name. Each part is asked for about equally often."""
    parts = I.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    seen = I.table(spark, sf_dir, "events", stream).select(
        (F.col("event_id") % parts.count()).alias("p_partkey"), "event_type", I.epoch_ms("ts").alias("ts"))
    pages = small_join(seen, parts, ["p_partkey"], parts=1).select("ts", I.pairs(
        last_page_id=F.when(F.col("event_type") == "view", "search").otherwise("home"), item_type=F.lit("keyword"),
        item=F.col("p_name")).alias("page"))
    return K.search_keywords(pages)


def keyword_window_count(spark, sf_dir):
    words = K.split_keywords(part_searches(spark, sf_dir), "keyword")
    return K.count_by_window(words, "10 minutes").drop("window_end")


def keyword_tokens_regex(spark, sf_dir):
    words = K.split_keywords(part_searches(spark, sf_dir), "keyword", "regex", r"[a-z]+")
    return words.groupBy("word").agg(F.count("*").alias("n"))


def keyword_tokens_dictionary(spark, sf_dir):
    """Part names without blanks, cut by the list of words that part names consist of."""
    parts = I.table(spark, sf_dir, "part")
    words = parts.select(F.explode(F.split("p_name", " ")).alias("w")).distinct()
    joined = parts.select("p_partkey", F.regexp_replace("p_name", " ", "").alias("text"))
    return K.split_keywords(joined, "text", "dictionary", words=words).select("p_partkey", "word")


def _trap_words(parts):
    """The words of part names, and each but the last with the first two letters of the one behind it: the longest word at a
    place is then often a wrong one."""
    pairs = F.explode(F.arrays_zip(F.slice("w", 1, F.size("w") - 1).alias("a"), F.slice("w", 2, F.size("w") - 1).alias("b"))).alias("p")
    split = parts.select(F.split("p_name", " ").alias("w"))
    return split.select(F.explode("w").alias("w")).unionByName(
        split.select(pairs).select(F.concat("p.a", F.left("p.b", F.lit(2))).alias("w"))).distinct()


def keyword_tokens_smart(spark, sf_dir):
    """Part names without blanks and with their number, cut along the best path over all listed words."""
    parts = I.table(spark, sf_dir, "part")
    joined = parts.select("p_partkey", F.concat(F.regexp_replace("p_name", " ", ""), F.lit("-"), I.text("p_partkey")).alias("text"))
    return K.split_keywords(joined, "text", "smart", words=_trap_words(parts)).select("p_partkey", "word")


# --- dates --------------------------------------------------------------------------------------------------------


def date_functions(spark, sf_dir):
    ms = I.epoch_ms("ts")
    zone = "Asia/Shanghai"
    e = I.table(spark, sf_dir, "events").select("event_id", ms.alias("ms"))
    return e.select(
        "event_id",
        D.ts_to_date("ms", UTC).alias("day"), D.ts_to_datetime("ms", UTC).alias("moment"),
        D.ts_to_partition("ms", UTC).alias("part"), D.ts_to_date("ms", zone).alias("day_east"),
        D.datetime_to_ts(D.ts_to_datetime("ms", zone)).alias("back_ms"),
        D.date_to_ts(D.ts_to_date("ms", zone)).alias("midnight_ms"),
    )


BATCH: dict[str, Query] = {
    f.__name__: f
    for f in (
        cdc_cleanse, cdc_cleanse_generic, exact_money, cart_add, cart_add_json, comment_insert, order_detail_insert,
        order_detail_view, order_info_insert, order_activity_insert, order_coupon_insert, order_cancel_update,
        payment_success_update,
        order_detail_wide, order_detail_wide_unbounded, order_cancel, order_cancel_unbounded, payment_interval,
        payment_interval_after_order, click_purchase_interval, payment_success, comment_lookup, dictionary_join,
        order_fact_topic, config_route_dwd, config_route_dwd_json, config_route_dim, dim_cell_merge,
        dim_cell_merge_nulls, config_feed, config_current, dim_registry, dim_tables, upsert_latest,
        upsert_with_deletes, upsert_messages, log_cleanse, visitor_fix, log_page, log_start, log_err, log_display,
        log_action, log_split, search_keyword, search_keyword_json, keyword_window_count, keyword_tokens_regex,
        keyword_tokens_dictionary, keyword_tokens_smart, date_functions,
    )
}
