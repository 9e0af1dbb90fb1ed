"""Columns carried as one text, and what that and batches in order of time save."""

from pyspark.sql import functions as F

from brookhouse.operators import joins as J
from brookhouse.operators.latest import DELETE, INSERT, fold_changes
from brookhouse.operators.packing import PACKED, packable, packed, unpacked
from brookhouse.plans import inputs as I
from brookhouse.plans import queries as Q
from brookhouse.plans import stream_queries as streams
from brookhouse.streaming import orders
from tests.conftest import SF

ODD = [None, "", "a", "\x1f", "\x1e", "\x1eN", "\x1eA", "\x1eB", "\x1e\x1f\x1eA\x1e", " N\t\n\\\"", "\x00", "é\U0001f600"]


def test_packed_columns_come_back_as_they_were(spark):
    texts = spark.createDataFrame([(t,) for t in ODD], "a string").crossJoin(spark.createDataFrame([(t,) for t in ODD], "b string"))
    df = texts.withColumns({"k": F.monotonically_increasing_id(), "n": F.when(F.col("a") != "a", F.length("a").cast("int")), "d": F.lit(0.1)})
    names = packable(df, df.columns)
    assert names == ["a", "b", "k", "n"]
    once = unpacked(packed(df, names), [df.schema[c] for c in names])
    assert once.select(*df.columns).dtypes == df.dtypes
    assert once.select(*df.columns).exceptAll(df).isEmpty() and df.exceptAll(once.select(*df.columns)).isEmpty()
    twice = packed(packed(df, ["a", "n"]), ["b"])
    assert unpacked(twice, [df.schema[c] for c in ("a", "n", "b")]).select(*df.columns).exceptAll(df).isEmpty()


def shuffled_columns(df):
    """The widest row that an exchange of the plan takes."""
    todo, widest = [df._jdf.queryExecution().sparkPlan(), df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        if "Exchange" in node.nodeName():
            widest = max(widest, node.output().size())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return widest


def test_order_lines_are_shuffled_packed(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffled_columns(Q.order_detail_wide(spark, SF)) <= 6
        assert shuffled_columns(Q.order_fact_topic(spark, SF)) <= 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_bucket_of_one_purchase_seldom_copies():
    assert J.SAME_PURCHASE.bucket >= 16 * (J.SAME_PURCHASE.upper - J.SAME_PURCHASE.lower) and J.Bounds(-5, 5).bucket == 40


def test_a_changelog_is_folded_packed(spark):
    rows = [("a", "x", None), ("a", "x", None), ("a", "x", "")]
    log = spark.createDataFrame([(INSERT, *r, 1) for r in rows] + [(DELETE, *rows[0], 1)], "op string, a string, b string, c string, n bigint")
    folded = fold_changes(log)
    assert folded.columns == ["a", "b", "c", "n"] and sorted(map(str, folded.collect())) == sorted(
        ["Row(a='a', b='x', c=None, n=1)", "Row(a='a', b='x', c='', n=1)"])
    assert PACKED in folded._jdf.queryExecution().executedPlan().toString()


def test_stored_orders_are_met_packed(spark, tmp_path, monkeypatch):
    made, kept = [], orders.packed
    monkeypatch.setattr(orders, "packed", lambda *a: (made.append(a[1]), kept(*a))[1])
    streams.stream_order_detail_wide(spark, SF)
    assert len(made) >= 6 and all(len(names) > 5 for names in made)


def batch_times(spark, monkeypatch, name):
    sent, kept = [], streams.Q.fact_lines
    monkeypatch.setattr(streams, "FACT_LINES", I.table(spark, SF, "lineitem").count() // 3)
    monkeypatch.setattr(streams.Q, "fact_lines", lambda *a, between=None, **kw: (sent.append(between), kept(*a, between=between, **kw))[1])
    return getattr(streams, name)(spark, SF), sent


def test_the_fact_topic_comes_in_batches_of_its_own_time(spark, monkeypatch):
    for name, whole in (("stream_order_cancel", Q.order_cancel), ("stream_payment_success", Q.payment_success)):
        with monkeypatch.context() as patch:
            got, sent = batch_times(spark, patch, name)
        assert len(sent) >= 3 and all(a[1] == b[0] for a, b in zip(sent, sent[1:]))
        want = whole(spark, SF).select(*got.columns)
        assert got.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_batches_of_the_topic_hold_each_line_once(spark):
    whole = Q.fact_lines(spark, SF).select("value")
    low, high = I.order_detail_changes(spark, SF).agg(F.min("ts"), F.max("ts")).first()
    cut = [low, low + 7, (low + high) // 2, high + 1]
    parts = [Q.fact_lines(spark, SF, between=b).select("value") for b in zip(cut, cut[1:])]
    both = parts[0].unionAll(parts[1]).unionAll(parts[2])
    assert both.count() == whole.count() and both.exceptAll(whole).isEmpty()


def test_a_small_state_is_on_the_heap(spark, monkeypatch):
    states, kept = [], streams.drain
    monkeypatch.setattr(streams, "drain", lambda rows, name, root, state: (states.append(state), kept(rows, name, root, state))[1])
    few = streams.stream_order_detail_wide_late(spark, SF)
    want = Q.order_detail_wide(spark, SF).select(*few.columns)
    assert few.exceptAll(want).isEmpty() and want.exceptAll(few).isEmpty()
    assert all("HDFSBacked" in s[streams.STATE_STORE] for s in states)
    assert [s["spark.sql.streaming.noDataMicroBatches.enabled"] for s in states] == ["false"] * 3 + ["true"]


def test_unordered_batches_take_their_lines_from_the_tables(spark, monkeypatch):
    monkeypatch.setattr(streams, "materialise", lambda *_: (_ for _ in ()).throw(AssertionError("all text written out before its batch")))
    lines = spark.range(0, 400, 1, 4).select(F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("at"), F.col("id").cast("string").alias("value"))
    *_, bus = streams.bus_in_batches(spark, "unordered", "t", lines, ordered=False)
    assert bus.read(spark, "t").distinct().count() == 400


def test_a_batch_leaves_no_shuffle_files(spark):
    with streams.small_footprint(spark):
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
