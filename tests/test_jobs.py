"""The jobs end to end over a folder bus, in several batches, with restarts."""

import dataclasses
import itertools
import json
import random

import pytest

from brookhouse import schemas as S
from brookhouse.operators import routing as R
from brookhouse.operators.changes import parse_changes
from brookhouse.operators.latest import compacted, fold_changes
from brookhouse.sources.bus import Bus
from brookhouse.streaming import jobs
from brookhouse.streaming.keyedlog import commit, numbered
from brookhouse.streaming.orders import TABLES, OrderState, order_rows
from brookhouse.streaming.sinks import append_jdbc, publish
from brookhouse.streaming.visitors import VisitorLog
from tests.conftest import rows
from tests.test_behaviour import ACTED, DAY, SHOWN, T0, random_visits, record, replay, visit

FAR = 4102444800


class Shop:
    """A deployment in a temporary folder."""

    def __init__(self, spark, root, **kw):
        self.spark, self.bus = spark, Bus("files", str(root / "bus"))
        self.settings = jobs.Settings(self.bus, "shop", str(root / "warehouse"), str(root / "checkpoints"), "UTC",
                                      window="10 seconds", **kw)
        self.sent = itertools.count()
        (root / "bus").mkdir()

    def send(self, topic, *records):
        df = self.spark.createDataFrame(
            [(topic, r if isinstance(r, str) else json.dumps(r)) for r in records], "topic string, value string")
        publish(self.bus, df, "producer", next(self.sent))

    def run(self, job, **kw):
        query = job(self.spark, self.settings, **kw)
        query.awaitTermination()
        return query

    def topic(self, name):
        return sorted((json.loads(r.value) for r in self.bus.read(self.spark, name).collect()),
                      key=lambda d: json.dumps(d, sort_keys=True))


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, tmp_path)


def change(table, kind, ts, data, old=None, database="shop"):
    return {"database": database, "table": table, "type": kind, "ts": ts, "xid": ts, "commit": True, "data": data} | (
        {"old": old} if old else {})


def dim_route(op, ts, table, sink, columns, key, before=None):
    image = {"source_table": table, "sink_table": sink, "sink_columns": columns, "sink_family": "info",
             "sink_row_key": key}
    return {"op": op, "before": image if op == "d" else before, "after": None if op == "d" else image, "ts_ms": ts}


DIC = dim_route("r", 1, "base_dic", "dim_base_dic", "dic_code,dic_name", "dic_code")


def test_cart_add_and_restart(shop):
    shop.send(S.TOPIC_DB, change("cart_info", "insert", 1, {"id": 1, "sku_num": 1}), "dirt")
    shop.run(jobs.dwd_trade_cart_add)
    shop.send(S.TOPIC_DB, change("cart_info", "update", 2, {"id": 1, "sku_num": 5}, {"sku_num": 2}),
              change("cart_info", "update", 3, {"id": 1, "sku_num": 4}, {"sku_num": 5}))
    shop.run(jobs.dwd_trade_cart_add)
    shop.run(jobs.dwd_trade_cart_add)  # nothing new
    assert shop.topic(S.CART_ADD) == [{"id": "1", "sku_num": "1", "ts": 1}, {"id": "1", "sku_num": "3", "ts": 2}]


def test_dimension_tables_follow_data_and_configuration(shop):
    tables = shop.settings.dimensions(shop.spark)
    shop.send(jobs.DIM_FEED, DIC, dim_route("r", 2, "user_info", "dim_user", "id,name,city", "id"))
    shop.send(S.TOPIC_DB, change("base_dic", "bootstrap-insert", 1, {"dic_code": "11", "dic_name": "paid", "x": 1}),
              change("user_info", "insert", 1, {"id": 7, "name": "n", "city": "c"}),
              change("user_info", "insert", 1, {"id": 8, "name": "gone"}),
              change("user_info", "insert", 1, {"id": 9}, database="other"),
              change("unknown", "insert", 1, {"id": 1}))
    shop.run(jobs.dim_app)
    shop.send(S.TOPIC_DB, change("user_info", "update", 2, {"id": 7, "name": None, "city": "d"}),
              change("user_info", "delete", 2, {"id": 8}))
    shop.run(jobs.dim_app)
    expected = [{"row_key": "7", "id": "7", "name": "n", "city": "d"}]
    assert rows(tables.read("dim_user", ["id", "name", "city"])) == expected
    assert rows(shop.settings.dictionary(shop.spark)) == [{"rowkey": "11", "info": {"dic_name": "paid"}}]
    tables.compact()
    assert rows(tables.read("dim_user", ["id", "name", "city"])) == expected
    # recreated: starts empty; deleted: no longer fed
    shop.send(jobs.DIM_FEED, dim_route("u", 5, "user_info", "dim_user", "id,name", "id"),
              dim_route("d", 6, "base_dic", "dim_base_dic", "dic_code,dic_name", "dic_code"))
    shop.send(S.TOPIC_DB, change("user_info", "insert", 3, {"id": 1, "name": "new", "city": "e"}),
              change("base_dic", "insert", 3, {"dic_code": "12", "dic_name": "late"}))
    shop.run(jobs.dim_app)
    assert rows(shop.settings.dimension(shop.spark, "dim_user", ["id", "name", "city"])) == [
        {"row_key": "1", "id": "1", "name": "new", "city": None}]
    assert rows(shop.settings.dictionary(shop.spark)) == []
    assert [r["row_key"] for r in rows(tables.read("dim_base_dic", ["dic_name"]))] == ["11"]


def test_changes_apply_as_they_come(shop):
    """One transaction, one second: the position on the bus decides, not the time, the transaction or the value."""
    tables = shop.settings.dimensions(shop.spark)
    shop.send(jobs.DIM_FEED, dim_route("r", 2, "user_info", "dim_user", "id,name,city", "id"))
    user = lambda kind, i, **cells: change("user_info", kind, 1, {"id": i, **cells})
    shop.send(S.TOPIC_DB, user("insert", 1, name="z"), user("update", 1, name="b"), user("insert", 2, name="old"), user("delete", 2),
              user("insert", 2, city="new"), user("insert", 3, name="n"), user("delete", 3))
    shop.run(jobs.dim_app)
    expected = [{"row_key": "1", "id": "1", "name": "b", "city": None}, {"row_key": "2", "id": "2", "name": None, "city": "new"}]
    assert rows(tables.read("dim_user", ["id", "name", "city"])) == expected
    tables.compact()
    assert rows(tables.read("dim_user", ["id", "name", "city"])) == expected


def test_null_writes_survive_compaction(shop):
    tables = shop.settings.dimensions(shop.spark)
    shop.send(jobs.DIM_FEED, dim_route("r", 2, "user_info", "dim_user", "id,name", "id"))
    shop.send(S.TOPIC_DB, change("user_info", "insert", 1, {"id": 1, "name": "a"}))
    shop.run(jobs.dim_app)
    shop.send(S.TOPIC_DB, change("user_info", "update", 2, {"id": 1, "name": None}))
    shop.run(jobs.dim_app)
    for _ in range(2):
        assert [r["name"] for r in rows(tables.read("dim_user", ["name"]))] == ["a"]
        assert [r["name"] for r in rows(tables.read("dim_user", ["name"], overwrite_nulls=True))] == [None]
        tables.compact()


def test_two_recreations_in_one_millisecond(shop):
    feed = [dim_route(op, 5, "user_info", "dim_user", "id", "id") | {"source": {"pos": pos}} for pos, op in enumerate("ruu")]
    shop.send(jobs.DIM_FEED, *feed[:2])
    shop.send(S.TOPIC_DB, change("user_info", "insert", 1, {"id": 1}))
    shop.run(jobs.dim_app)
    shop.send(jobs.DIM_FEED, feed[2])
    shop.send(S.TOPIC_DB, change("user_info", "insert", 1, {"id": 2}))
    shop.run(jobs.dim_app)
    assert [r["id"] for r in rows(shop.settings.dimension(shop.spark, "dim_user", ["id"]))] == ["2"]


def test_a_lost_checkpoint_loses_nothing(shop, tmp_path):
    shop.send(jobs.DIM_FEED, dim_route("r", 2, "user_info", "dim_user", "id,name", "id"))
    shop.send(S.TOPIC_DB, change("user_info", "insert", 1, {"id": 1, "name": "a"}), change("cart_info", "insert", 1, {"id": 1}))
    shop.run(jobs.dim_app)
    shop.run(jobs.dwd_trade_cart_add)
    shop.settings = dataclasses.replace(shop.settings, checkpoints=str(tmp_path / "renewed"))
    shop.send(S.TOPIC_DB, change("user_info", "update", 1, {"id": 1, "name": "b"}), change("cart_info", "insert", 1, {"id": 2}))
    shop.run(jobs.dim_app)
    shop.run(jobs.dwd_trade_cart_add)
    assert [r["name"] for r in rows(shop.settings.dimension(shop.spark, "dim_user", ["name"]))] == ["b"]
    assert {r["id"] for r in shop.topic(S.CART_ADD)} == {"1", "2"}


def test_facts_routed_by_configuration(shop):
    def route(op, ts, kind, sink):
        image = {"source_table": "coupon_use", "source_type": kind, "sink_table": sink, "sink_columns": "id,user_id"}
        return {"op": op, "before": image if op == "d" else None, "after": None if op == "d" else image, "ts_ms": ts}

    shop.send(jobs.FACT_FEED, route("r", 1, "insert", "dwd_tool_coupon_get"), route("r", 1, "update", "dwd_tool_coupon_use"))
    row = {"id": 1, "user_id": 2, "secret": 3}
    shop.send(S.TOPIC_DB, change("coupon_use", "insert", 1, row), change("coupon_use", "update", 2, row),
              change("coupon_use", "delete", 3, row), "")
    shop.run(jobs.dwd_base_db)
    shop.send(jobs.FACT_FEED, route("d", 2, "update", "dwd_tool_coupon_use"))
    shop.send(S.TOPIC_DB, change("coupon_use", "update", 4, row))
    shop.run(jobs.dwd_base_db)
    for topic in ("dwd_tool_coupon_get", "dwd_tool_coupon_use"):
        assert shop.topic(topic) == [{"id": "1", "user_id": "2"}]


def purchase(i, ts):
    """One order with two lines; the first has an activity, the second a coupon."""
    o, a, b = f"o{i}", f"d{i}a", f"d{i}b"
    return [
        change("order_detail", "insert", ts, {"id": a, "order_id": o, "sku_id": 1}),
        change("order_detail", "insert", ts, {"id": b, "order_id": o, "sku_id": 2}),
        change("order_info", "insert", ts, {"id": o, "province_id": 3, "user_id": f"u{i}"}),
        change("order_detail_activity", "insert", ts, {"order_detail_id": a, "activity_id": 4, "activity_rule_id": 5}),
        change("order_detail_coupon", "insert", ts, {"order_detail_id": b, "coupon_id": 6}),
    ]


def ending(ts=FAR):
    """Far-future records, one per branch, that close what is open."""
    return [
        change("order_detail", "insert", ts, {"id": "end", "order_id": "end1"}),
        change("order_info", "insert", ts, {"id": "end2"}),
        change("order_detail_activity", "insert", ts, {"order_detail_id": "end3"}),
        change("order_detail_coupon", "insert", ts, {"order_detail_id": "end4"}),
    ]


def test_order_chain(shop):
    """Order lines, then cancellations and payments from the order-line topic, with the dictionary of payment types."""
    shop.send(jobs.DIM_FEED, DIC)
    shop.send(S.TOPIC_DB, change("base_dic", "insert", 1, {"dic_code": "1101", "dic_name": "wallet"}))
    shop.run(jobs.dim_app)
    shop.send(S.TOPIC_DB, *purchase(1, 10_000), *purchase(2, 10_020))
    shop.run(jobs.dwd_trade_order_detail)
    shop.send(S.TOPIC_DB, *purchase(3, 10_040), *ending())
    shop.run(jobs.dwd_trade_order_detail)
    lines = shop.topic(S.ORDER_DETAIL)
    assert [(r["id"], r["user_id"], r.get("activity_id"), r.get("coupon_id"), r["ts"]) for r in sorted(
        lines, key=lambda r: r["id"])] == [
        x for i in (1, 2, 3) for x in (
            (f"d{i}a", f"u{i}", "4", None, 9_980 + 20 * i), (f"d{i}b", f"u{i}", None, "6", 9_980 + 20 * i))]

    shop.send(S.TOPIC_DB, change("order_info", "update", 10_900, {
        "id": "o1", "order_status": "1003", "operate_time": "2024-06-19 08:00:00"}, {"order_status": "1001"}))
    shop.run(jobs.dwd_trade_order_cancel_detail)
    assert [(r["id"], r["order_cancel_date_id"], r["ts"]) for r in sorted(
        shop.topic(S.ORDER_CANCEL), key=lambda r: r["id"])] == [
        ("d1a", "2024-06-19", 10_900), ("d1b", "2024-06-19", 10_900)]

    def pay(order, kind, ts):
        return change("payment_info", "update", ts, {
            "id": f"p-{order}", "order_id": order, "user_id": "payer", "payment_type": kind, "callback_time": "t",
            "payment_status": "1602"}, {"payment_status": "1601"})

    shop.send(S.TOPIC_DB, pay("o1", "1101", 10_005), pay("o2", "9999", 10_000), pay("o3", "1101", 10_046))
    shop.run(jobs.dwd_trade_order_pay_suc_detail)
    want = [("d1a", "wallet"), ("d1b", "wallet"), ("d2a", None), ("d2b", None)]
    paid = sorted(shop.topic(S.PAYMENT_SUCCESS), key=lambda r: r["id"])
    assert [(r["id"], r.get("payment_type_name")) for r in paid] == want
    assert [(r["id"], r["payment_type_name"]) for r in rows(jobs.current_payments(shop.spark, shop.settings))] == want


def named(change_row, order):
    return change_row | {"data": change_row["data"] | {"order_id": order}}


def changelog(state, spark, batch_id, *records):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    found = state.changes(order_rows(parse_changes(df), "shop"), batch_id)
    return sorted((r["op"], r["id"], r["user_id"], r["activity_id"], r["coupon_id"]) for r in rows(found))


def test_padded_rows_are_retracted(spark, tmp_path):
    state = OrderState(spark, str(tmp_path / "orders"))
    first, second, order, activity, coupon = purchase(1, 10)
    assert changelog(state, spark, 0, first) == []  # no order yet
    padded = ("d1a", "u1", None, None)
    assert changelog(state, spark, 1, order) == [("+I", *padded)]
    full = ("d1a", "u1", "4", None)
    assert changelog(state, spark, 2, named(activity, "o1")) == [("+I", *full), ("-D", *padded)]
    assert changelog(state, spark, 2, named(activity, "o1")) == [("+I", *full), ("-D", *padded)]  # repeated
    assert changelog(state, spark, 3, second, named(coupon, "o1")) == [("+I", "d1b", "u1", None, "6")]
    two = named(coupon, "o1") | {"data": {"order_id": "o1", "order_detail_id": "d1a", "coupon_id": 7}}
    assert changelog(state, spark, 4, two, two) == [("+I", "d1a", "u1", "4", "7")] * 2 + [("-D", *full)]
    state.compact()
    assert changelog(state, spark, 5, order) == [("+I", "d1a", "u1", "4", "7")] * 2 + [("+I", "d1b", "u1", None, "6")]


def test_changelog_folds_to_the_join(spark, tmp_path):
    """Rows in random batches, some of them twice, dealt to three parts."""
    r = random.Random(2)
    records = [x for i in range(25) for x in purchase(i, 10)]
    records = [named(x, f"o{x['data']['order_detail_id'][1:-1]}") if "order_detail_id" in x["data"] else x for x in records]
    records += r.sample(records, 12)
    r.shuffle(records)
    state, log = OrderState(spark, str(tmp_path / "orders")), None
    for k in range(4):
        part = spark.createDataFrame([(json.dumps(x),) for x in records[k::4]], "value string")
        found = state.changes(order_rows(parse_changes(part), "shop", 3), k).persist()
        found.count()
        log = found if log is None else log.unionByName(found)
    of = {t: [x["data"] for x in records if x["table"] == t] for t in TABLES}
    want = sorted(
        (d["id"], o["user_id"], a and str(a["activity_id"]), c and str(c["coupon_id"])) for d in of["order_detail"] for o in of["order_info"] if o["id"] == d["order_id"]
        for a in [a for a in of["order_detail_activity"] if a["order_detail_id"] == d["id"]] or [None]
        for c in [c for c in of["order_detail_coupon"] if c["order_detail_id"] == d["id"]] or [None])
    got = rows(fold_changes(log))
    assert sorted(((x["id"], x["user_id"], x["activity_id"], x["coupon_id"]) for x in got), key=str) == sorted(want, key=str)


def test_idle_orders_are_forgotten(spark, tmp_path):
    now = [1000.0]
    state = OrderState(spark, str(tmp_path / "orders"), 5, lambda: now[0])
    first, second, order, activity, _ = purchase(1, 10)
    assert changelog(state, spark, 0, first, order) == [("+I", "d1a", "u1", None, None)]
    now[0] += 4
    assert changelog(state, spark, 1, second) == [("+I", "d1b", "u1", None, None)]  # renews the order
    now[0] += 4
    assert changelog(state, spark, 2, named(activity, "o1")) == [("+I", "d1a", "u1", "4", None), ("-D", "d1a", "u1", None, None)]
    now[0] += 5.5
    assert changelog(state, spark, 3, first) == []  # the order is gone
    now[0] += 6
    state.compact()
    assert state.log.read().count() == 0


def test_early_order_lines(shop):
    first, second, order, activity, coupon = purchase(1, 10)
    shop.send(S.TOPIC_DB, first, second, order)
    shop.run(jobs.dwd_trade_order_detail, early=True)
    shop.send(S.TOPIC_DB, named(activity, "o1"), named(coupon, "o1"))
    shop.run(jobs.dwd_trade_order_detail, early=True)
    sent = [(r["id"], r.get("activity_id"), r.get("coupon_id")) for r in shop.topic(S.ORDER_DETAIL)]
    assert sorted(sent, key=str) == sorted([("d1a", None, None), ("d1b", None, None), ("d1a", "4", None), ("d1b", None, "6")], key=str)
    now = compacted(shop.bus.read_keyed(shop.spark, S.ORDER_DETAIL))
    assert sorted((json.loads(r.value)["id"], json.loads(r.value).get("activity_id")) for r in now.collect()) == [("d1a", "4"), ("d1b", None)]


def test_a_key_without_value_is_deleted(spark, tmp_path):
    bus = Bus("files", str(tmp_path / "bus"))

    def send(n, *messages):
        publish(bus, spark.createDataFrame([("t", *m) for m in messages], "topic string, key string, value string"), "shop", n)

    send(0, ("1", '{"v":"a\\tb"}'), ("2", '{"v":2}'), ("3", '{"v":3}'))
    send(1, ("2", None), ("3", '{"v":4}'))
    send(2, ("1", None), ("2", '{"v":5}'))
    assert sorted(tuple(r) for r in compacted(bus.read_keyed(spark, "t")).collect()) == [("2", '{"v":5}'), ("3", '{"v":4}')]
    assert sorted(r.value for r in bus.read(spark, "t").collect()) == sorted(["", "", '{"v":2}', '{"v":3}', '{"v":4}', '{"v":5}', '{"v":"a\\tb"}'])


def test_only_committed_batches_are_read(spark, tmp_path):
    bus, root = Bus("files", str(tmp_path / "bus")), tmp_path / "bus/shop"
    df = spark.createDataFrame([("t", "one")], "topic string, value string")
    publish(bus, df, "shop", 0)
    half = root / "_staging/broken/topic=t"  # a writer that died
    half.mkdir(parents=True)
    (half / "part-0").write_text("half\n")
    assert [r.value for r in bus.read(spark, "t").collect()] == ["one"]
    publish(bus, df, "shop", 0)  # redone after the commit
    publish(bus, df.selectExpr("topic", "'two' AS value"), "shop", 1)
    commit(spark, str(root / "_staging/broken"), str(root / "batch_id=1"))  # too late
    stream = bus.stream(spark, "t").writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    stream.start().awaitTermination()
    assert sorted(r.value for r in spark.table("seen").collect()) == sorted(r.value for r in bus.read(spark, "t").collect()) == ["one", "two"]


def test_a_batch_reads_only_what_is_new_on_the_feed(shop):
    table = shop.settings.routes(shop.spark, jobs.DIM_FEED, S.DIM_ROUTE, R.DIM_KEY)

    def live(routes):
        return {(r["source_table"], r["sink_table"]) for r in rows(routes.live())}

    assert live(table.advance(0)) == set()
    shop.send(jobs.DIM_FEED, DIC, dim_route("r", 2, "user_info", "dim_user", "id", "id"), "dirt")
    one = table.advance(1)
    assert (one.read, live(one)) == (3, {("base_dic", "dim_base_dic"), ("user_info", "dim_user")})
    shop.send(jobs.DIM_FEED, dim_route("u", 5, "user_info", "dim_person", "id", "id"))
    two = table.advance(2)
    assert (two.read, live(two)) == (1, {("base_dic", "dim_base_dic"), ("user_info", "dim_person")})
    assert live(table.advance(1)) == live(one)  # repeated: as it was
    none = table.advance(3)
    assert (none.read, live(none)) == (0, live(two))
    shop.send(jobs.DIM_FEED, dim_route("d", 4, "user_info", "dim_user", "id", "id"), dim_route("d", 6, "base_dic", "dim_base_dic", "dic_code", "dic_code"))
    assert live(table.current()) == {("user_info", "dim_person")} and len(table._states()) == 3  # nothing is written
    four = table.advance(4)
    assert (four.read, live(four)) == (2, {("user_info", "dim_person")})
    assert {(r["sink_table"], r["generation"]) for r in rows(four.registered())} == {("dim_person", "5-0")}


def test_comments(shop):
    shop.send(jobs.DIM_FEED, DIC)
    shop.send(S.TOPIC_DB, change("base_dic", "insert", 1, {"dic_code": "1201", "dic_name": "good"}),
              change("comment_info", "insert", 2, {"id": 1, "appraise": "1201", "head_img": "h"}),
              change("comment_info", "insert", 2, {"id": 2, "appraise": "1202"}))
    shop.run(jobs.dim_app)
    shop.run(jobs.dwd_interaction_comment_info)
    # a name that arrives later is seen by later batches
    shop.send(S.TOPIC_DB, change("base_dic", "insert", 3, {"dic_code": "1202", "dic_name": "bad"}),
              change("comment_info", "insert", 4, {"id": 3, "appraise": "1202"}))
    shop.run(jobs.dim_app)
    shop.run(jobs.dwd_interaction_comment_info)
    assert shop.topic(S.COMMENT_INFO) == [
        {"id": "1", "appraise_code": "1201", "appraise_name": "good"},
        {"id": "3", "appraise_code": "1202", "appraise_name": "bad"}]


@pytest.mark.parametrize("native", [False, True])
def test_behaviour_log(shop, native):
    visits = sorted(random_visits(5, 90), key=lambda v: v[2])
    for part in (visits[:30], visits[30:60], visits[60:]):
        shop.send(S.TOPIC_LOG, *[visit(*v) for v in part])
        shop.run(jobs.dwd_base_log, native_state=native)
    if native:  # a far-future record lets the watermark pass the others
        shop.send(S.TOPIC_LOG, visit("end", "1", FAR * 1000))
    shop.run(jobs.dwd_base_log, native_state=native)
    got = [(r["common"]["mid"], r["ts"], r["common"]["is_new"]) for r in shop.topic(S.TRAFFIC_PAGE)]
    assert sorted(x for x in got if x[0] != "end") == replay(visits)
    if not native:
        log = VisitorLog(shop.spark, f"{shop.settings.warehouse}/visitors", "UTC")
        assert log.log.read().groupBy("mid").count().filter("count > 1").count() == 0
        log.compact()
        shop.send(S.TOPIC_LOG, visit("hot", "1", T0 + 40 * DAY))
        shop.run(jobs.dwd_base_log)
        late = [r for r in shop.topic(S.TRAFFIC_PAGE) if r["ts"] == T0 + 40 * DAY]
        assert late[0]["common"]["is_new"] == "0"


def test_behaviour_topics(shop):
    shop.send(S.TOPIC_LOG, record(displays=SHOWN, actions=ACTED, err={"error_code": 1, "msg": "m"}),
              record(page=None, start={"entry": "icon"}), "dirt", "")
    shop.run(jobs.dwd_base_log)
    counts = {t: len(shop.topic(t)) for t in (S.TRAFFIC_PAGE, S.TRAFFIC_START, S.TRAFFIC_ERR, S.TRAFFIC_DISPLAY,
                                              S.TRAFFIC_ACTION)}
    assert list(counts.values()) == [1, 1, 1, 3, 1]
    assert shop.topic(S.TRAFFIC_ERR) == [{"error_code": 1, "msg": "m"}]


def test_a_repeated_visitor_batch_gives_the_same_result(spark, shop, lines):
    from brookhouse.operators.behaviour import clean_log

    visitors = VisitorLog(spark, f"{shop.settings.warehouse}/v", "UTC")

    def batch(n, *visits):
        with visitors.repaired(clean_log(lines(*[visit(*v) for v in visits])), n) as fixed:
            return [r["is_new"] for r in rows(fixed.select("ts", "common.is_new"))]

    first, second = (("m", "1", T0),), (("m", "1", T0 + DAY), ("n", "0", T0), ("n", "1", T0 + 1))
    assert batch(0, *first) == ["1"]
    once = batch(1, *second)
    assert once == batch(1, *second) == ["0", "0", "0"]


def test_keywords(shop):
    def page(word, ts, **kw):
        return {"common": {"mid": "m"}, "ts": ts,
                "page": {"last_page_id": "search", "item_type": "keyword", "item": word} | kw}

    shop.send(S.TRAFFIC_PAGE, page("red phone", 1000), page("phone", 9000), page("x", 9000, last_page_id="home"))
    shop.run(jobs.dws_traffic_source_keyword_page_view_window)
    shop.send(S.TRAFFIC_PAGE, page("phone", 12_000), page("end", FAR * 1000))
    shop.run(jobs.dws_traffic_source_keyword_page_view_window)
    table = shop.spark.read.parquet(f"{shop.settings.warehouse}/{S.KEYWORD_WINDOW}/delta")
    assert sorted(tuple(r)[:4] for r in table.select("window_start", "window_end", "keyword", "views").collect()) == [
        (0, 10_000, "phone", 2), (0, 10_000, "red", 1), (10_000, 20_000, "phone", 1)]


def test_a_window_counted_again_is_there_once(shop, tmp_path):
    """By a repeated batch, by a run with a new checkpoint, and after compaction."""
    page = {"ts": 1000, "page": {"last_page_id": "search", "item_type": "keyword", "item": "phone"}}
    shop.send(S.TRAFFIC_PAGE, page, page | {"ts": FAR * 1000})
    shop.run(jobs.dws_traffic_source_keyword_page_view_window)
    table = jobs.keyword_table(shop.spark, shop.settings)
    before = rows(jobs.current_counts(shop.spark, shop.settings))
    assert [r["views"] for r in before] == [1]
    table.append(table.read().drop("batch_id"), numbered(shop.spark, f"{table.root}/delta", "batch_id")[-1])
    shop.settings = dataclasses.replace(shop.settings, checkpoints=str(tmp_path / "renewed"))
    shop.run(jobs.dws_traffic_source_keyword_page_view_window)
    assert table.read().count() == 2 and rows(jobs.current_counts(shop.spark, shop.settings)) == before
    table.compact(jobs.merge_counts)
    assert table.read().count() == 1 and rows(jobs.current_counts(shop.spark, shop.settings)) == before


def test_late_records_are_dropped_by_the_watermark(shop):
    def page(ts):
        return {"ts": ts, "page": {"last_page_id": "search", "item_type": "keyword", "item": "w"}}

    for ts in (100_000, 200_000, 50_000, FAR * 1000):
        shop.send(S.TRAFFIC_PAGE, page(ts))
        shop.run(jobs.dws_traffic_source_keyword_page_view_window)
    table = shop.spark.read.parquet(f"{shop.settings.warehouse}/{S.KEYWORD_WINDOW}/delta")
    assert sorted(r.window_start for r in table.collect()) == [100_000, 200_000]


def test_kafka_options(spark):
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, f):
            self.seen["format"] = f
            return self

        def option(self, k, v):
            self.seen[k] = v
            return self

        def options(self, **kw):
            self.seen.update(kw)
            return self

        def load(self):
            return spark.createDataFrame([(b"x", 0, 1), (None, 0, 2), (b"", 0, 3)],
                                         "value binary, partition int, offset bigint")

    reader = Reader()
    got = Bus("kafka", "b1:9092,b2:9092", {"maxOffsetsPerTrigger": "10"})._kafka(reader, "topic_db")
    assert reader.seen == {"format": "kafka", "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "topic_db",
                           "startingOffsets": "earliest", "maxOffsetsPerTrigger": "10"}
    assert [tuple(r) for r in got.orderBy("offset").collect()] == [(x, "0" * 10, n) for x, n in (("x", 1), ("", 2), ("", 3))]


def test_kafka_producer_options(monkeypatch):
    seen = {}

    class Writer:
        def option(self, k, v):
            seen[k] = v
            return self

        def options(self, **kw):
            seen.update(kw)
            return self

        def format(self, f):
            seen["format"] = f
            return self

        def save(self):
            seen["saved"] = True

    class Messages:
        columns, write = ["topic", "key", "value", "other"], Writer()

        def select(self, *columns):
            seen["columns"] = columns
            return self

    secure = {"kafka.security.protocol": "SASL_SSL", "kafka.acks": "all"}
    publish(Bus("kafka", "b1:9092", producer=secure), Messages(), "job", 0)
    assert seen == {"format": "kafka", "kafka.bootstrap.servers": "b1:9092", "columns": ("topic", "key", "value"), "saved": True} | secure


def test_jdbc_sink_options(monkeypatch):
    class Writer:
        seen = {}

        @property
        def write(self):
            return self

        def format(self, f):
            self.seen["format"] = f
            return self

        def option(self, k, v):
            self.seen[k] = v
            return self

        def options(self, **kw):
            self.seen.update(kw)
            return self

        def mode(self, m):
            self.seen["mode"] = m
            return self

        def save(self):
            self.seen["saved"] = True

    append_jdbc(Writer(), "jdbc:x", "t", {"user": "u"})
    assert Writer.seen == {"format": "jdbc", "url": "jdbc:x", "dbtable": "t", "user": "u", "mode": "append",
                           "saved": True}


def test_console(shop, tmp_path):
    from brookhouse.streaming.sinks import to_console

    shop.send(S.TRAFFIC_PAGE, {"ts": 1})
    query = to_console(shop.bus.stream(shop.spark, S.TRAFFIC_PAGE), str(tmp_path / "console"), {"availableNow": True})
    query.awaitTermination()
    assert query.recentProgress[-1].numInputRows == 1


def test_jobs_are_complete():
    assert len(jobs.JOBS) == 9


def test_a_lookup_opens_the_buckets_of_its_codes(spark, shop):
    tables = shop.settings.dimensions(spark)
    codes = [str(k) for k in range(60)]
    shop.send(jobs.DIM_FEED, DIC)
    shop.send(S.TOPIC_DB, *[change("base_dic", "insert", 1, {"dic_code": c, "dic_name": f"n{c}"}) for c in codes])
    shop.run(jobs.dim_app)
    for compacted_ in (False, True):
        if compacted_:
            tables.compact()
        asked = spark.createDataFrame([("7",), (None,), ("7",)], "payment_type string")
        some = shop.settings.dictionary(spark, asked)
        found = {r["rowkey"] for r in rows(some)}
        files = {f.split("/")[-2] for f in tables.events("dim_base_dic", keys=asked).inputFiles()}
        assert "7" in found and 0 < len(found) < 30 and len(files) == 1
        assert {r["rowkey"] for r in rows(shop.settings.dictionary(spark))} == set(codes)


def test_stored_first_visits_are_not_shuffled(spark, shop, lines):
    from brookhouse.operators.behaviour import clean_log

    visitors = VisitorLog(spark, f"{shop.settings.warehouse}/v", "UTC")
    with visitors.repaired(clean_log(lines(*[visit(f"m{k}", "1", T0) for k in range(40)])), 0) as fixed:
        assert fixed.count() == 40
    bucket = spark.sql("SELECT cast(pmod(xxhash64('m7'), 16) AS int)").first()[0]
    seen = spark.createDataFrame([("m7", bucket), ("unseen", bucket)], "mid string, bucket int")
    known = visitors.known(seen, 1)
    stored = known._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(mid" not in stored and "BroadcastHashJoin" in stored and "bucket" in stored.split("PartitionFilters:")[1][:80]
    assert [r.mid for r in known.collect()] == ["m7"]
