"""What larger tables cost: text on the bus, tasks that write it, shuffles."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brookhouse.plans import inputs as I
from brookhouse.plans import queries as Q
from brookhouse.plans import stream_queries as streams
from brookhouse.sources.bus import Bus
from brookhouse.streaming.sinks import publish
from tests.conftest import SF


def sent(bus, number):
    return list(Path(bus.location).glob(f"*/batch_id={number}/*/part-*"))


@pytest.mark.parametrize("key", [None, "k"])
def test_the_text_on_a_bus_is_compressed(spark, tmp_path, key):
    bus = Bus("files", str(tmp_path / "bus"))
    lines = spark.range(10_000).select(F.lit("t").alias("topic"), F.format_string('{"a_long_field_name":%d}', "id").alias("value"))
    publish(bus, lines.withColumn("key", F.lit(key)) if key else lines, "w", 0)
    assert sum(f.stat().st_size for f in sent(bus, 0)) < 10_000 * 8
    assert bus.read(spark, "t").distinct().count() == 10_000


def test_the_fact_topic_is_written_where_the_last_join_left_it(spark):
    plan = Q.fact_lines(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION" not in plan


@pytest.mark.parametrize("query, facts", [
    (Q.order_cancel, Q.J.order_cancel_wide), (Q.order_cancel_unbounded, Q.J.order_cancel_wide), (Q.payment_interval, Q.J.paid_order_lines),
    (Q.payment_interval_after_order, Q.J.paid_order_lines), (Q.payment_success, Q.J.paid_order_lines)])
def test_only_lines_that_can_be_met_are_carried_to_the_last_join(spark, monkeypatch, query, facts):
    carried = []
    monkeypatch.setattr(Q.J, facts.__name__, lambda lines, *rest: (carried.append(lines), facts(lines, *rest))[1])
    met = query(spark, SF).count()
    assert 0 < met <= carried[0].count() < Q.fact_table(spark, SF).count() / 2


def test_unordered_batches_are_written_by_several_tasks(spark):
    lines = spark.range(0, 4000, 1, 4).select(F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("at"), F.col("id").cast("string").alias("value"))
    for k, bus in enumerate(streams.bus_in_batches(spark, "unordered", "t", lines, ordered=False)):
        assert len(sent(bus, k)) == 4
    assert bus.read(spark, "t").distinct().count() == 4000


@pytest.mark.parametrize("name, batches", [("stream_order_detail_wide", 3), ("stream_order_detail_wide_late", 4)])
def test_the_order_log_comes_in_several_batches(spark, monkeypatch, name, batches):
    buses, kept = [], streams.publish
    monkeypatch.setattr(streams, "publish", lambda bus, *sent_: (buses.append(bus), kept(bus, *sent_)))
    getattr(streams, name)(spark, SF)
    assert len(buses) == batches and (name.endswith("late") or all(len(sent(buses[0], k)) > 1 for k in range(3)))


def test_more_messages_are_dealt_to_more_tasks(spark, monkeypatch):
    few, many = spark.range(1000).withColumnRenamed("id", "ts"), spark.range(40_000).withColumnRenamed("id", "ts")
    monkeypatch.setattr(I, "PARTITION_ROWS", 1000)
    assert I.dealt(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert I.dealt(many).rdd.getNumPartitions() == 40


def test_ordered_batches_take_their_lines_from_the_tables(spark, monkeypatch):
    monkeypatch.setattr(streams, "materialise", lambda *_: pytest.fail("all text written out before its batch"))
    rows = spark.range(0, 3000, 1, 4).select((F.pow(F.lit(3000) - F.col("id"), 2)).cast("bigint").alias("at"))
    lines = rows.union(rows.limit(5)).withColumn("value", F.col("at").cast("string"))
    for k, bus in enumerate(streams.bus_in_batches(spark, "ordered", "t", lines)):
        texts = [spark.read.text(str(f)) for f in sorted(sent(bus, k))]
        numbers = [[int(r.value) for r in t.collect()] for t in texts]
        assert len(numbers) == 4 and max(map(len, numbers)) < 1.2 * sum(map(len, numbers)) / 4
        assert sum(numbers, []) == sorted(sum(numbers, []))
    assert bus.read(spark, "t").count() == 3005 and bus.read(spark, "t").distinct().count() == 3000
    assert list(streams.bus_in_batches(spark, "none", "t", lines.limit(0)))


def test_a_batch_under_repair_is_kept_without_what_nobody_looks_at(spark, monkeypatch):
    kept, repaired = [], streams.VisitorLog.repaired
    monkeypatch.setattr(streams.VisitorLog, "repaired", lambda log, batch, n: (kept.append(batch.columns), repaired(log, batch, n))[1])
    got = streams.stream_visitor_fix(spark, SF)
    assert kept == [["common", "ts"]] * 3
    assert sorted(got.collect()) == sorted(Q.visitor_fix(spark, SF).select(*got.columns).collect())
