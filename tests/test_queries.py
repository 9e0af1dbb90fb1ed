"""Registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from brookhouse.plans.queries import BATCH
from brookhouse.plans.stream_queries import STREAMS
from tests.conftest import SF
from tools.check import compare, connect


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(BATCH | STREAMS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(BATCH))
def test_batch_query(spark, duck, name):
    assert compare(spark, duck, name, SF).startswith("ok")


@pytest.mark.parametrize("name", list(STREAMS))
def test_streaming_query(spark, duck, name):
    assert compare(spark, duck, name, SF).startswith("ok")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["topic", "value"] and df.count() > 0


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Shanghai"])
def test_results_do_not_depend_on_the_session_zone(spark, duck, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for name in ("visitor_fix", "date_functions", "payment_interval", "keyword_window_count", "order_cancel",
                     "order_fact_topic", "click_purchase_interval"):
            assert compare(spark, duck, name, SF).startswith("ok"), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
