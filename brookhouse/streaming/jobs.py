"""The warehouse's nine streaming jobs: wiring of sources, operators and sinks."""

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from brookhouse import schemas as S
from brookhouse.operators import behaviour, facts, joins, keyword, lookup, routing
from brookhouse.operators.changes import clean_changes, parse_changes
from brookhouse.operators.latest import latest_by_key
from brookhouse.operators.skew import every_key
from brookhouse.sources.bus import Bus, change_log, json_table, positioned, timed_json_table
from brookhouse.sources.jdbc import read_routes
from brookhouse.streaming import sinks
from brookhouse.streaming.dimtables import DimensionTables
from brookhouse.streaming.keyedlog import KeyedLog, in_order
from brookhouse.streaming.orders import TABLES, OrderState, order_rows
from brookhouse.streaming.routes import RouteTable, table_now
from brookhouse.streaming.visitors import VisitorLog, repair_stream

# Topics of the routing tables' change feeds.
FACT_FEED = "table_process_dwd"
DIM_FEED = "table_process_dim"


@dataclass(frozen=True)
class Settings:
    """Where a deployment keeps its things. `database` is the shop's database, `warehouse` and `checkpoints` shared folders.

    `zone` decides calendar days (None: session zone). `salt` above 1 is the number of tasks that share the lines of one
    order in joins; orders are copied as often. Keyed tables are compacted each `compact_every` micro-batches (0: never),
    dimension tables have `buckets` folders of row keys. `config_url` preloads routing tables over JDBC. `idle`: seconds (of `clock`) that early order
    lines keep an order after its last row; None: for ever.
    """

    bus: Bus
    database: str
    warehouse: str
    checkpoints: str
    zone: str | None = None
    trigger: dict = field(default_factory=lambda: {"availableNow": True})
    delay: str = "5 seconds"
    salt: int = 1
    compact_every: int = 100
    buckets: int = 8
    window: str = "10 seconds"
    idle: float | None = None
    clock: Callable[[], float] = time.time
    config_url: str | None = None
    config_properties: dict[str, str] = field(default_factory=dict)
    olap_url: str | None = None
    olap_properties: dict[str, str] = field(default_factory=dict)

    def run(self, rows: DataFrame, name: str, sink) -> StreamingQuery:
        rows.sparkSession.conf.set(sinks.STATE_STORE, sinks.ROCKSDB)
        return sinks.start(rows, name, self.checkpoints, self.trigger, sink)

    def publish(self, name: str):
        """Sink that sends (topic, value) rows as they are."""
        return lambda batch, batch_id: sinks.publish(self.bus, batch, name, batch_id)

    def changes(self, spark: SparkSession, *tables: str) -> DataFrame:
        return change_log(self.bus.stream(spark, S.TOPIC_DB), tables, self.delay)

    def dimensions(self, spark: SparkSession) -> DimensionTables:
        return DimensionTables(spark, f"{self.warehouse}/dim", self.buckets)

    def dimension(self, spark: SparkSession, sink_table: str, columns: list[str], keys: DataFrame | None = None) -> DataFrame:
        """Current rows of a dimension table, by the configuration as it is now; a dropped table has none. `keys`: a column of
        the row keys that are asked for; other buckets are not opened.

        A table that only the preloaded snapshot names has had no action and is in generation 0. The configuration is that
        of the dimension job's routes, with what is new on the feed.
        """
        generation, dropped = table_now(self.routes(spark, DIM_FEED, S.DIM_ROUTE, routing.DIM_KEY).current(), sink_table)
        rows = self.dimensions(spark).read(sink_table, columns, generation, keys=keys)
        return rows.limit(0) if dropped else rows

    def dictionary(self, spark: SparkSession, codes: DataFrame | None = None) -> DataFrame:
        """Dictionary as it is now, or at least its rows of some codes."""
        return lookup.dictionary_rows(self.dimension(spark, S.DIM_DICTIONARY, ["dic_name"], codes), "row_key")

    def routes(self, spark: SparkSession, table: str, route, key: list[str]) -> RouteTable:
        def snapshot() -> DataFrame:
            return read_routes(spark, self.config_url, table, self.config_properties)

        return RouteTable(spark, f"{self.warehouse}/routes/{table}", self.bus, table, route, key, snapshot if self.config_url else None)


def dim_app(spark: SparkSession, s: Settings) -> StreamingQuery:
    """Business changes into dimension tables, by configuration."""
    tables = s.dimensions(spark)

    def sink(batch: DataFrame, batch_id: int) -> None:
        routes = s.routes(batch.sparkSession, DIM_FEED, S.DIM_ROUTE, routing.DIM_KEY).advance(batch_id)
        routed = routing.route_dimensions(clean_changes(positioned(batch), s.database), routes.live())
        tables.write(routed, routes.registered(), batch_id)
        if s.compact_every and (batch_id + 1) % s.compact_every == 0:
            tables.compact()

    return s.run(s.bus.stream(spark, S.TOPIC_DB, positions=True), "dim_app", sink)


def dwd_base_log(spark: SparkSession, s: Settings, native_state: bool = False) -> StreamingQuery:
    """Behaviour log: repair the new-visitor flag, split into five topics."""
    log = behaviour.clean_log(s.bus.stream(spark, S.TOPIC_LOG))
    if native_state:
        zone = s.zone or spark.conf.get("spark.sql.session.timeZone")
        return s.run(behaviour.split_messages(repair_stream(log, zone, s.delay)), "dwd_base_log", s.publish("dwd_base_log"))
    visitors = VisitorLog(spark, f"{s.warehouse}/visitors", s.zone)

    def sink(batch: DataFrame, batch_id: int) -> None:
        with visitors.repaired(batch, batch_id) as repaired:
            sinks.publish(s.bus, behaviour.split_messages(repaired), "dwd_base_log", batch_id)
        if s.compact_every and (batch_id + 1) % s.compact_every == 0:
            visitors.compact()

    return s.run(log, "dwd_base_log", sink)


def dwd_base_db(spark: SparkSession, s: Settings) -> StreamingQuery:
    """Business changes into fact topics, by configuration."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        routes = s.routes(batch.sparkSession, FACT_FEED, S.FACT_ROUTE, routing.FACT_KEY).advance(batch_id)
        routed = routing.route_facts(parse_changes(batch), routes.live())
        sinks.publish(s.bus, routing.routed_messages(routed), "dwd_base_db", batch_id)

    return s.run(s.bus.stream(spark, S.TOPIC_DB), "dwd_base_db", sink)


def dwd_trade_cart_add(spark: SparkSession, s: Settings) -> StreamingQuery:
    rows = facts.cart_adds(s.changes(spark, "cart_info"), s.database)
    return s.run(sinks.json_messages(rows, S.CART_ADD), "dwd_trade_cart_add", s.publish("dwd_trade_cart_add"))


def dwd_trade_order_detail(spark: SparkSession, s: Settings, early: bool = False) -> StreamingQuery:
    """Order lines with buyer, activity and coupon. A line is sent once, when its optional parts can no longer come; `early`
    sends it as soon as its order is there, and again whenever an optional part comes (activities and coupons must name
    their order for that)."""
    if early:
        return _early_order_detail(spark, s)
    db = s.database
    wide = joins.order_detail_wide(
        facts.order_detail_inserts(s.changes(spark, "order_detail"), db),
        facts.order_info_inserts(s.changes(spark, "order_info"), db),
        facts.activity_inserts(s.changes(spark, "order_detail_activity"), db),
        facts.coupon_inserts(s.changes(spark, "order_detail_coupon"), db),
        order_salt=every_key(s.salt),
    ).drop("row_time")
    messages = sinks.upsert_messages(wide, S.ORDER_DETAIL, ["id"])
    return s.run(messages, "dwd_trade_order_detail", s.publish("dwd_trade_order_detail"))


def _early_order_detail(spark: SparkSession, s: Settings) -> StreamingQuery:
    name = "dwd_trade_order_detail"
    state = OrderState(spark, f"{s.warehouse}/open_orders", s.idle, s.clock)

    def sink(batch: DataFrame, batch_id: int) -> None:
        changes = state.changes(order_rows(batch, s.database, s.salt), batch_id)
        sinks.publish(s.bus, sinks.upsert_changes(changes, S.ORDER_DETAIL, ["id"]), name, batch_id)
        if s.compact_every and (batch_id + 1) % s.compact_every == 0:
            state.compact()

    return s.run(parse_changes(s.bus.stream(spark, S.TOPIC_DB), TABLES), name, sink)


def dwd_trade_order_cancel_detail(spark: SparkSession, s: Settings) -> StreamingQuery:
    rows = joins.order_cancel_wide(
        timed_json_table(s.bus.stream(spark, S.ORDER_DETAIL), S.ORDER_DETAIL_FACT, s.delay),
        facts.order_cancels(s.changes(spark, "order_info"), s.database),
        salt=every_key(s.salt),
    )
    name = "dwd_trade_order_cancel_detail"
    return s.run(sinks.json_messages(rows, S.ORDER_CANCEL), name, s.publish(name))


def payment_table(spark: SparkSession, s: Settings) -> KeyedLog:
    """Paid order lines as a keyed table."""
    fields = S.strings("id", "order_id", "user_id", "payment_type_code", "payment_type_name", "payment_time", "sku_id",
                       "province_id", "activity_id", "activity_rule_id", "coupon_id", "sku_name", "order_price",
                       "sku_num", "split_total_amount", "split_activity_amount", "split_coupon_amount")
    return KeyedLog(spark, f"{s.warehouse}/{S.PAYMENT_SUCCESS}", S.T.StructType([*fields, *S.longs("ts")]))


def current_payments(spark: SparkSession, s: Settings) -> DataFrame:
    log = payment_table(spark, s).read()
    return latest_by_key(log, ["id"], in_order("ts")).drop("batch_id")


def dwd_trade_order_pay_suc_detail(
    spark: SparkSession, s: Settings, bounds: joins.Bounds = joins.PAYMENT_WINDOW
) -> StreamingQuery:
    """Paid order lines with the name of the payment type, to a compacted topic and a keyed table."""
    name = "dwd_trade_order_pay_suc_detail"
    paid = joins.paid_order_lines(
        timed_json_table(s.bus.stream(spark, S.ORDER_DETAIL), S.ORDER_DETAIL_FACT, s.delay),
        facts.payments(s.changes(spark, "payment_info"), s.database),
        bounds,
        every_key(s.salt),
    )
    table = payment_table(spark, s)

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = lookup.payment_facts(batch, s.dictionary(batch.sparkSession, batch.select("payment_type"))).persist()
        try:
            sinks.upsert_rows(table, rows, batch_id)
            sinks.publish(s.bus, sinks.upsert_messages(rows, S.PAYMENT_SUCCESS, ["id"]), name, batch_id)
        finally:
            rows.unpersist()

    return s.run(paid, name, sink)


def dwd_interaction_comment_info(spark: SparkSession, s: Settings) -> StreamingQuery:
    name = "dwd_interaction_comment_info"

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = lookup.comment_facts(batch, s.dictionary(batch.sparkSession, batch.select("appraise")))
        sinks.publish(s.bus, sinks.json_messages(rows, S.COMMENT_INFO), name, batch_id)

    return s.run(facts.comments(s.changes(spark, "comment_info"), s.database), name, sink)


KEYWORD_COUNTS = S.T.StructType([*S.longs("window_start", "window_end"), *S.strings("keyword"), *S.longs("views")])


def keyword_table(spark: SparkSession, s: Settings) -> KeyedLog:
    return KeyedLog(spark, f"{s.warehouse}/{S.KEYWORD_WINDOW}", KEYWORD_COUNTS)


def merge_counts(log: DataFrame) -> DataFrame:
    """The last count of each window and keyword, so a window that a renewed run counts again is there once."""
    return latest_by_key(log, ["window_start", "window_end", "keyword"], in_order()).drop("batch_id")


def current_counts(spark: SparkSession, s: Settings) -> DataFrame:
    return merge_counts(keyword_table(spark, s).read())


def dws_traffic_source_keyword_page_view_window(
    spark: SparkSession, s: Settings, mode: str = "whitespace", words: DataFrame | None = None
) -> StreamingQuery:
    """Views per search keyword and window, to an OLAP table over JDBC (a repeated batch is appended again) or to a table in
    the warehouse (it is not), which `current_counts` reads by window and keyword."""
    name = S.KEYWORD_WINDOW
    pages = json_table(s.bus.stream(spark, S.TRAFFIC_PAGE), S.PAGE_INFO)
    tokens = keyword.split_keywords(keyword.search_keywords(pages), "keyword", mode, words=words)
    counts = keyword.count_by_window(tokens, s.window, s.delay)
    table = keyword_table(spark, s)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if s.olap_url:
            sinks.append_jdbc(batch, s.olap_url, name, s.olap_properties)
            return
        table.append(batch, batch_id)
        if s.compact_every and (batch_id + 1) % s.compact_every == 0:
            table.compact(merge_counts)

    return s.run(counts, name, sink)


JOBS = {
    f.__name__: f
    for f in (
        dim_app, dwd_base_log, dwd_base_db, dwd_trade_cart_add, dwd_trade_order_detail, dwd_trade_order_cancel_detail,
        dwd_trade_order_pay_suc_detail, dwd_interaction_comment_info, dws_traffic_source_keyword_page_view_window,
    )
}
