import pytest
from pyspark.sql import functions as F

from brookhouse import schemas as S
from brookhouse.operators import routing as R
from brookhouse.operators.changes import parse_changes
from tests.conftest import rows

SEED = [  # routing rows as the shop configures them
    ("coupon_use", "insert", "dwd_tool_coupon_get", "id,coupon_id,user_id,get_time,coupon_status"),
    ("coupon_use", "update", "dwd_tool_coupon_use", "id,coupon_id,user_id,order_id,using_time,used_time,coupon_status"),
    ("favor_info", "insert", "dwd_interaction_favor_add", "id,user_id,sku_id,create_time"),
    ("user_info", "insert", "dwd_user_register", "id,create_time"),
]


def fact(source_table, source_type, sink_table, sink_columns="id"):
    return dict(zip(S.FACT_ROUTE.fieldNames(), (source_table, source_type, sink_table, sink_columns)))


def dim(source_table, sink_table, sink_columns="id", sink_family="info", sink_row_key="id"):
    return dict(zip(S.DIM_ROUTE.fieldNames(), (source_table, sink_table, sink_columns, sink_family, sink_row_key)))


@pytest.fixture
def feed(lines):
    def make(*events, route=S.FACT_ROUTE):
        records = [{"op": op, "before": b, "after": a, "ts_ms": i, "source": {"pos": i}, "transaction": None}
                   for i, (op, b, a) in enumerate(events)]
        return R.decode_feed(lines(*records), route)
    return make


def current(feed_df, snapshot=None):
    got = R.current_routes(snapshot, feed_df, S.FACT_ROUTE, R.FACT_KEY)
    return {(r["source_table"], r["source_type"]): r["sink_table"] for r in rows(got)}


def test_decode_takes_the_image_that_counts(lines):
    got = rows(R.decode_feed(lines(
        {"op": "r", "before": None, "after": fact("a", "insert", "s1"), "ts_ms": 1},
        {"op": "d", "before": fact("b", "insert", "s2"), "after": None, "ts_ms": 2},
        {"op": "d", "before": None, "after": fact("c", "insert", "s3")},
        "dirt",
    ), S.FACT_ROUTE).select("source_table", "op"))
    assert [tuple(r.values()) for r in got] == [("a", "r"), ("b", "d")]


def test_last_change_wins_and_delete_removes(feed):
    a1, a2, b = fact("a", "insert", "s1"), fact("a", "insert", "s2"), fact("b", "insert", "s3")
    assert current(feed(("c", None, a1), ("c", None, b), ("u", a1, a2), ("d", b, None))) == {("a", "insert"): "s2"}
    assert current(feed(("d", b, None), ("c", None, b))) == {("b", "insert"): "s3"}


def test_snapshot_serves_untouched_keys(spark, feed):
    snapshot = spark.createDataFrame(SEED, S.FACT_ROUTE)
    got = current(feed(("d", fact("user_info", "insert", "dwd_user_register"), None),
                       ("u", None, fact("favor_info", "insert", "elsewhere"))), snapshot)
    assert got == {("coupon_use", "insert"): "dwd_tool_coupon_get", ("coupon_use", "update"): "dwd_tool_coupon_use",
                   ("favor_info", "insert"): "elsewhere"}


def test_moved_route_leaves_its_old_key(feed):
    old, new = fact("a", "insert", "s1"), fact("a", "update", "s1")
    assert current(feed(("c", None, old), ("u", old, new))) == {("a", "update"): "s1"}


def test_two_targets_of_one_key_keep_the_later(feed):
    assert current(feed(("c", None, fact("a", "insert", "s2")), ("c", None, fact("a", "insert", "s1")))) == {
        ("a", "insert"): "s1"}


def test_facts_are_pruned_and_tagged(spark, lines):
    log = parse_changes(lines(
        {"database": "any", "table": "user_info", "type": "insert", "data": {"id": 1, "create_time": None, "pw": "x"}},
        {"table": "user_info", "type": "update", "data": {"id": 2}},
        {"table": "favor_info", "type": "insert", "data": {"id": 3, "userid": 1, "user_id": 5}},
    ))
    routed = R.route_facts(log, spark.createDataFrame(SEED, S.FACT_ROUTE))
    got = {r["sink_table"]: r["data"] for r in rows(routed)}
    assert got == {"dwd_user_register": {"id": "1", "create_time": None},
                   "dwd_interaction_favor_add": {"id": "3", "user_id": "5"}}
    sent = {r["topic"]: r["value"] for r in rows(R.routed_messages(routed))}
    assert sent["dwd_user_register"] == '{"id":"1"}'


def test_listed_names_must_match_exactly(spark):
    df = spark.sql("select map('a', '1', ' b', '2', 'b', '3') as data, 'a, b' as cols")
    assert df.select(R.keep_listed(F.col("data"), F.col("cols")).alias("d")).first().d == {"a": "1", " b": "2"}


def test_dimension_key_may_be_pruned(spark, lines):
    log = parse_changes(lines(
        {"table": "base_dic", "type": "insert", "ts": 5, "data": {"dic_code": "11", "dic_name": "n", "x": 1}},
        {"table": "base_dic", "type": "insert", "ts": 6, "data": {"dic_name": "no key"}},
        {"table": "unlisted", "type": "insert", "ts": 7, "data": {"dic_code": "12"}},
    ))
    routes = spark.createDataFrame([("base_dic", "dim_base_dic", "dic_name", "info", "dic_code")], S.DIM_ROUTE)
    (row,) = rows(R.route_dimensions(log, routes))
    assert (row["sink_table"], row["row_key"], row["type"], row["ts"], row["data"], row["sink_family"]) == (
        "dim_base_dic", "11", "insert", 5, {"dic_name": "n"}, "info")


def test_registry(feed):
    a, b, c = dim("a", "dim_a"), dim("b", "dim_b"), dim("c", "dim_c")
    changes = feed(("r", None, a), ("c", None, b), ("u", a, a), ("d", b, None), ("c", None, c), ("c", None, c),
                   route=S.DIM_ROUTE)
    actions = R.registry_actions(changes)
    assert [r["action"] for r in rows(actions.orderBy("seq").select("seq", "action"))] == [
        "create", "create", "recreate", "drop", "create", "create"]
    got = {r["sink_table"]: r["generation"] for r in rows(R.registered_tables(actions))}
    assert got == {"dim_a": "2-2", "dim_c": "0"}


def test_routes_are_broadcast(spark):
    log = spark.createDataFrame([("t", "insert", {"id": "1"})], "`table` string, type string, data map<string,string>")
    plan = R.route_facts(log, spark.createDataFrame(SEED, S.FACT_ROUTE))._jdf.queryExecution().executedPlan()
    assert "BroadcastHashJoin" in plan.toString()


def test_column_lists_are_split_once_per_route(spark, lines):
    log = parse_changes(lines({"table": "user_info", "type": "insert", "data": {"id": 1, "pw": "x"}}))
    dims = spark.createDataFrame([("user_info", "dim_user", "id,name", "info", "id")], S.DIM_ROUTE)
    for routed in (R.route_facts(log, spark.createDataFrame(SEED, S.FACT_ROUTE)), R.route_dimensions(log, dims)):
        assert "array_contains(split(" not in routed._jdf.queryExecution().optimizedPlan().toString()
        assert [r["data"].get("id") for r in rows(routed)] == ["1"]
