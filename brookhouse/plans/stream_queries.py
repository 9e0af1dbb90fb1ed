"""Streaming twins of registered queries: the tables are read as a stream and drained; results equal the batch form.

Output and checkpoint go to the shared scratch folder.
"""

from contextlib import ExitStack, contextmanager, nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookhouse import schemas as S
from brookhouse.functions.jsons import to_line
from brookhouse.operators import behaviour as B
from brookhouse.operators import facts
from brookhouse.operators import joins as J
from brookhouse.operators import keyword as K
from brookhouse.operators import lookup as L
from brookhouse.operators import routing as R
from brookhouse.operators.changes import parse_changes
from brookhouse.operators.latest import DELETE, INSERT, compacted, fold_changes, latest_by_key
from brookhouse.operators.sizing import materialise, new_scratch  # noqa: F401 (tests watch that it is not called)
from brookhouse.plans import inputs as I
from brookhouse.plans import queries as Q
from brookhouse.sources.bus import Bus, change_log, json_table, timed_json_table
from brookhouse.streaming.jobs import DIM_FEED, Settings, dim_app
from brookhouse.streaming.orders import ACTIVITY, COUPON, LINE, ORDER, TABLES, OrderState, order_rows
from brookhouse.streaming.sinks import ROCKSDB, STATE_STORE, publish, start, upsert_changes
from brookhouse.streaming.visitors import VisitorLog, repair_stream

NOW = {"availableNow": True}
@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Change a session setting for the streams started inside; they keep it, the session does not."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    with ExitStack() as kept:
        for key, value in values.items():
            kept.enter_context(setting(spark, key, value))
        yield


def small_footprint(spark: SparkSession):
    """What a write or a micro-batch has shuffled leaves the disk with its end."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


# State off the heap, in one store a task. Rows are not counted with each of them, and what is old leaves the disk.
FEW_VERSIONS = {"spark.sql.streaming.minBatchesToRetain": "2", "spark.sql.streaming.stateStore.maintenanceInterval": "10s"}
STATE = FEW_VERSIONS | {
    STATE_STORE: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
# State on the heap, for streams that come in batches of a bounded size: some ten times as fast a row.
SMALL_STATE = FEW_VERSIONS | {STATE_STORE: "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"}


def drain(rows: DataFrame, name: str, root: str | None = None, state: dict[str, str] = STATE) -> DataFrame:
    """Run a stream to the end of its input into a table, and read the table. With the `root` of an earlier call the stream
    goes on where that one ended. Of its state only the last versions are kept."""
    spark, root = rows.sparkSession, root or new_scratch(rows.sparkSession, name)
    with settings(spark, state), small_footprint(spark):
        query = (
            rows.writeStream.format("parquet").option("compression", "zstd").option("checkpointLocation", f"{root}/checkpoint")
            .outputMode("append").trigger(**NOW).start(f"{root}/out")
        )
        query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


def drain_batches(rows: DataFrame, name: str, each, root: str | None = None) -> DataFrame:
    """Same, with a function of (root, micro-batch, number) that gives the rows to store, or a context that they are stored in.
    With the `root` of an earlier call the stream goes on where that one ended."""
    spark, root = rows.sparkSession, root or new_scratch(rows.sparkSession, name)

    def sink(batch, batch_id):
        stored = each(root, batch, batch_id)
        with nullcontext(stored) if isinstance(stored, DataFrame) else stored as result:
            result.write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}", compression="zstd")

    with settings(spark, STATE), small_footprint(spark):
        start(rows, name, f"{root}/checkpoint", NOW, sink).awaitTermination()
    return spark.read.option("mergeSchema", "false").parquet(f"{root}/out").drop("batch_id")


def stream_cart_add(spark, sf_dir):
    return drain(facts.cart_adds(I.log_of(I.cart_changes, spark, sf_dir, True), Q.DB), "stream_cart_add")


def stream_order_detail_wide(spark, sf_dir):
    """One state for all four sides, over three micro-batches in no order at all: what the changelog leaves. Activities and
    coupons come before or after their lines."""
    log = I.order_log(spark, sf_dir)
    anywhere = F.pmod(F.xxhash64("table", F.col("data")["id"], F.col("data")["order_detail_id"]), F.lit(1 << 30))
    lines = log.select(anywhere.alias("at"), to_line("database", "table", "type", "ts", "data").alias("value"))

    def changes(root, batch, batch_id):
        return OrderState(batch.sparkSession, f"{root}/open_orders").changes(order_rows(batch, Q.DB), batch_id)

    root = new_scratch(spark, "stream_order_detail_wide")
    for bus in bus_in_batches(spark, "stream_order_detail_wide", S.TOPIC_DB, lines, ordered=False):
        whole = Bus(bus.kind, bus.location).stream(spark, S.TOPIC_DB)
        rows = drain_batches(parse_changes(whole, TABLES), "stream_order_detail_wide", changes, root)
    return fold_changes(rows)


# Lines of a micro-batch in time order: what the joins of a stream keep at once.
STATE_LINES = 800_000


def stream_order_detail_wide_late(spark, sf_dir):
    """The same by chained joins: each line once, when the watermark says that nothing can come any more. The log comes in
    order of time, in more micro-batches the longer it is, so the state holds no more than two of them: on the heap, in as many
    tasks as there are cores, unless the log is so uneven in time that one is very large. The log's end closes what is open then."""
    name = "stream_order_detail_wide_late"
    root, line = new_scratch(spark, name), to_line("database", "table", "type", "ts", "data").alias("value")
    log = I.order_log(spark, sf_dir).select(F.col("ts").alias("at"), line)
    at = I.order_detail_changes(spark, sf_dir).select(F.col("ts").alias("at"))
    batches = max(3, -(-at.count() // STATE_LINES))
    batch = share_of(log, batches)
    busiest = at.groupBy(batch).count().agg(F.max("count")).first()[0] or 0
    small = SMALL_STATE | {"spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}
    state = small if busiest <= 2 * STATE_LINES else STATE

    def drained(bus, last=False):
        log = {t: change_log(bus.stream(spark, S.TOPIC_DB), (t,)) for t in TABLES}
        wide = J.order_detail_wide(
            facts.order_detail_inserts(log[LINE], Q.DB), facts.order_info_inserts(log[ORDER], Q.DB),
            facts.activity_inserts(log[ACTIVITY], Q.DB), facts.coupon_inserts(log[COUPON], Q.DB))
        return drain(wide.drop("row_time"), name, root, state | {"spark.sql.streaming.noDataMicroBatches.enabled": str(last).lower()})

    for bus in bus_in_batches(spark, name, S.TOPIC_DB, log, batches, batch=batch):
        whole = Bus(bus.kind, bus.location)
        drained(whole)
    ends = reduce(DataFrame.unionByName, [I.sentinel(spark, sf_dir, t, stream=False) for t in TABLES])
    publish(whole, ends.select(F.lit(S.TOPIC_DB).alias("topic"), line), "end", 0)
    return drained(whole, last=True)


def upsert_topic(spark, sf_dir):
    """The last order of each customer through a compacted topic: an order with status P deletes its customer's row.

    Each of several batches sends one message per key, as a producer does that compacts what it sends.
    """
    rows = I.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    key, bus = ["o_custkey"], Bus("files", new_scratch(spark, "upsert_topic"))
    most = rows.agg(F.max("o_orderkey")).first()[0] or 0
    for k in range(3):
        last = latest_by_key(rows.filter((F.col("o_orderkey") * 3 / F.lit(most + 1)).cast("int") == k), key, F.col("o_orderkey"))
        changes = last.select(F.when(F.col("o_orderstatus") == "P", DELETE).otherwise(INSERT).alias("op"), *rows.columns)
        publish(bus, upsert_changes(changes, "last_order", key), "shop", k)
    return json_table(compacted(bus.read_keyed(spark, "last_order")).select("value"), rows.schema)


# Order lines of a batch of their topic: what the joins behind it keep at once.
FACT_LINES = 3_000_000


def fact_batches(spark, sf_dir):
    """The order-detail topic as a stream, as it is after each of its batches: the messages that the batch form writes to a
    bus of folders, in order of time. A batch is made of its own time only, and the longer the log, the more there are."""
    bus = Bus("files", new_scratch(spark, "bus"))
    log = I.order_detail_changes(spark, sf_dir).select("ts")
    n = -(-log.count() // FACT_LINES)
    low, high, *inner = log.agg(F.min("ts"), F.max("ts"), *[F.percentile_approx("ts", k / n) for k in range(1, n)]).first()
    edges = sorted({x for x in (low, *inner) if x is not None} | ({high + 1} if high is not None else {0, 1}))
    for k, between in enumerate(zip(edges, edges[1:])):
        with small_footprint(spark):
            publish(bus, Q.fact_lines(spark, sf_dir, between=between), "order_detail", k)
        yield timed_json_table(bus.stream(spark, S.ORDER_DETAIL), S.ORDER_DETAIL_FACT)


def stream_order_cancel(spark, sf_dir):
    """Interval join in the stream, of a topic that comes in batches and the cancellations of all orders."""
    root = new_scratch(spark, "stream_order_cancel")
    for lines in fact_batches(spark, sf_dir):
        cancels = facts.order_cancels(I.log_of(I.order_cancel_changes, spark, sf_dir, True), Q.DB)
        rows = drain(J.order_cancel_wide(lines, cancels), "stream_order_cancel", root)
    return rows


def stream_payment_success(spark, sf_dir):
    """Interval join in the stream, dictionary looked up for each micro-batch."""
    def named(root, batch, batch_id):
        return L.payment_facts(batch, L.dictionary_rows(I.dictionary(batch.sparkSession, sf_dir), "dic_code"))

    root = new_scratch(spark, "stream_payment_success")
    for lines in fact_batches(spark, sf_dir):
        paid = J.paid_order_lines(lines, facts.payments(I.log_of(I.payment_changes, spark, sf_dir, True), Q.DB))
        rows = drain_batches(paid, "stream_payment_success", named, root)
    return rows


def stream_comment_lookup(spark, sf_dir):
    comments = facts.comments(I.log_of(I.comment_changes, spark, sf_dir, True), Q.DB)

    def named(root, batch, batch_id):
        return L.comment_facts(batch, L.dictionary_rows(I.dictionary(batch.sparkSession, sf_dir), "dic_code"))

    return drain_batches(comments, "stream_comment_lookup", named)


def stream_config_route_dwd(spark, sf_dir):
    def routed(root, batch, batch_id):
        return R.routed_messages(R.route_facts(batch, Q.fact_routes(batch.sparkSession)))

    changes = I.generic_changes(spark, sf_dir, True)
    return drain_batches(changes, "stream_config_route_dwd", routed)


def range_of(at, bounds, first=0):
    """Which of the ranges between bounds a number is in: below the first one, or from the n-th one on."""
    if not bounds:
        return F.lit(first)
    n = len(bounds) // 2
    return F.when(F.col(at) < bounds[n], range_of(at, bounds[:n], first)).otherwise(range_of(at, bounds[n + 1:], first + n + 1))


def share_of(lines, batches):
    """Which of several batches, equal ranges of `at`, a line is in."""
    low, high = lines.agg(F.min("at"), F.max("at")).first()
    return ((F.col("at") - F.lit(low or 0)) * batches / F.lit((high or 0) - (low or 0) + 1)).cast("int")


def bus_in_batches(spark, name, topic, lines, batches=3, ordered=True, batch=None):
    """A bus of folders to which lines (a number `at` that orders them, text `value`) are sent in several batches, as it is
    after each of them. A batch is a range of `at`, written in order to as many files as there are cores, as a producer does
    with its partitions; a stream that is not ended in between reads as many files at a time. What `at` is made of is read
    for the ranges first, so a batch takes its lines from the tables and builds their text once. Not `ordered`, a batch is
    written as its lines lie there, without a shuffle. `batch`: see `share_of`."""
    files = spark.sparkContext.defaultParallelism
    bus = Bus("files", new_scratch(spark, name), {"maxFilesPerTrigger": str(files)})
    batch = share_of(lines, batches) if batch is None else batch
    bounds = {k: [] for k in range(batches)}
    if ordered and files > 1:
        even = F.percentile_approx("at", [n / files for n in range(1, files)])
        bounds |= dict(lines.groupBy(batch).agg(even).collect())  # a row per batch
    for k in range(batches):
        part = lines.filter(batch == k)
        if ordered:
            part = part.repartitionById(files, range_of("at", sorted(set(bounds[k])))).sortWithinPartitions("at")
        with small_footprint(spark):
            publish(bus, part.select(F.lit(topic).alias("topic"), "value"), "shop", k)
        yield bus


def dimension_job(spark, sf_dir, name, lines, routes, compact_every):
    """Settings of a deployment whose dimension job has run over the lines, batch by batch."""
    root = new_scratch(spark, name)
    for k, bus in enumerate(bus_in_batches(spark, name, S.TOPIC_DB, lines)):
        if not k:
            publish(bus, I.feed_lines(spark, routes, S.DIM_ROUTE).select(F.lit(DIM_FEED).alias("topic"), "value"), "config", 0)
        whole = Bus(bus.kind, bus.location)
        settings = Settings(whole, Q.DB, f"{root}/warehouse", f"{root}/checkpoints", Q.UTC, compact_every=compact_every)
        dim_app(spark, settings).awaitTermination()
    return settings


def _customer_lines(spark, sf_dir):
    """Changes of the customer dimension as text; a row's delete and the next put share second and transaction."""
    data = F.map_concat(I.pairs(id=I.text("row_key")), F.col("data"))
    return I.dim_changes(spark, sf_dir).select(F.col("seq").alias("at"), to_line_with_nulls(
        database=F.lit(Q.DB), table=F.lit("customer_info"), type=F.col("type"), ts=F.lit(1), xid=F.lit(1), data=data))


def to_line_with_nulls(**fields):
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"}).alias("value")


def _dim_cell_merge(spark, sf_dir, overwrite_nulls, name):
    routes = [("r", None, ("customer_info", "dim_customer", "prio,st", "info", "id"))]
    tables = dimension_job(spark, sf_dir, name, _customer_lines(spark, sf_dir), routes, 2).dimensions(spark)
    rows = tables.read("dim_customer", ["prio", "st"], overwrite_nulls=overwrite_nulls)
    return rows.withColumn("row_key", F.col("row_key").cast("bigint"))


def stream_dim_cell_merge(spark, sf_dir):
    """The dimension job over several micro-batches, compacted midway."""
    return _dim_cell_merge(spark, sf_dir, False, "stream_dim_cell_merge")


def stream_dim_cell_merge_nulls(spark, sf_dir):
    return _dim_cell_merge(spark, sf_dir, True, "stream_dim_cell_merge_nulls")


def stream_config_route_dim(spark, sf_dir):
    """Orders and lines through the dimension job: what its log of changes holds for the routed tables."""
    lines = I.generic_changes(spark, sf_dir)
    lines = lines.select(F.col("ts").alias("at"), to_line_with_nulls(
        database=F.col("database"), table=F.col("table"), type=F.col("type"), ts=F.col("ts"), xid=F.lit(1), data=F.col("data")))

    log = dimension_job(spark, sf_dir, "stream_config_route_dim", lines, I.DIM_FEED, 0).dimensions(spark).log
    return log.read().select("sink_table", F.lit("info").alias("sink_family"), "row_key", "type", F.explode("data").alias("col", "val"))


def _visitors(log):
    return log.select(
        F.col("common.sid").alias("sid"), F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
        "ts")


def stream_visitor_fix(spark, sf_dir):
    """First visits kept as a keyed table, over several micro-batches. A batch is kept while it is repaired, so it has no more
    columns than the repair and the result look at."""
    @contextmanager
    def repaired(root, batch, batch_id):
        with VisitorLog(batch.sparkSession, f"{root}/visitors", Q.UTC).repaired(batch, batch_id) as log:
            yield _visitors(log)

    lines = I.behaviour_log(spark, sf_dir).select(F.col("ts").alias("at"), to_line("common", "page", "start", "ts").alias("value"))
    root = new_scratch(spark, "stream_visitor_fix")
    for bus in bus_in_batches(spark, "stream_visitor_fix", S.TOPIC_LOG, lines):
        whole = Bus(bus.kind, bus.location).stream(spark, S.TOPIC_LOG)
        rows = drain_batches(B.clean_log(whole).select("common", "ts"), "stream_visitor_fix", repaired, root)
    return rows


def stream_visitor_fix_native(spark, sf_dir):
    """First visits kept in the state store. Records come up to two hours late, also across batches; the last one lets the
    watermark pass all others."""
    log = I.behaviour_log(spark, sf_dir)
    line = to_line("common", "page", "start", "ts").alias("value")
    late = F.pmod(F.xxhash64("common.sid"), F.lit(2 * 3_600_000))
    lines = log.select((F.col("ts") + late).alias("at"), line)
    *_, bus = bus_in_batches(spark, "stream_visitor_fix_native", S.TOPIC_LOG, lines)
    end = log.limit(1).withColumns({
        "common": F.col("common").withField("mid", F.lit("end")).withField("sid", F.lit("end")), "ts": F.lit(I.FAR_SECONDS * 1000).cast("bigint")})
    publish(bus, end.select(F.lit(S.TOPIC_LOG).alias("topic"), line), "end", 0)
    rows = drain(_visitors(repair_stream(B.clean_log(bus.stream(spark, S.TOPIC_LOG)), Q.UTC, "3 hours")), "stream_visitor_fix_native")
    return rows.filter(F.col("sid") != "end")


def stream_log_split(spark, sf_dir):
    """The behaviour log from a bus of several files."""
    lines = I.behaviour_lines(spark, sf_dir)
    bus = Bus("files", new_scratch(spark, "stream_log_split"))
    publish(bus, lines.select(F.lit(S.TOPIC_LOG).alias("topic"), "value"), "shop", 0)
    return drain(B.split_messages(B.clean_log(bus.stream(spark, S.TOPIC_LOG))), "stream_log_split")


def stream_keyword_window_count(spark, sf_dir):
    searches = Q.part_searches(spark, sf_dir, stream=True)
    end = I.table(spark, sf_dir, "region", stream=True).filter("r_regionkey = 0").select(
        F.lit("end").alias("keyword"), F.lit(I.FAR_SECONDS * 1000).cast("bigint").alias("ts"))
    words = K.split_keywords(searches.unionByName(end), "keyword")
    counts = K.count_by_window(words, "10 minutes").filter(F.col("window_start") < I.FAR_SECONDS * 1000)
    return drain(counts.drop("window_end"), "stream_keyword_window_count")


STREAMS: dict[str, Q.Query] = {
    f.__name__: f
    for f in (
        stream_cart_add, stream_order_detail_wide, stream_order_detail_wide_late, stream_order_cancel, stream_payment_success, stream_comment_lookup,
        stream_config_route_dwd, stream_dim_cell_merge, stream_dim_cell_merge_nulls, stream_config_route_dim,
        stream_visitor_fix, stream_visitor_fix_native, stream_log_split,
        stream_keyword_window_count, upsert_topic,
    )
}
# Each twin is checked against the SQL of its batch form.
TWIN_OF = {name: name.removeprefix("stream_") for name in STREAMS} | {
    "stream_visitor_fix_native": "visitor_fix", "stream_config_route_dwd": "config_route_dwd_json",
    "stream_order_detail_wide_late": "order_detail_wide", "upsert_topic": "upsert_with_deletes",
}
