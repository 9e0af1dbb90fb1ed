import pytest
from pyspark.sql import functions as F

from brookhouse.operators import lookup as L
from brookhouse.operators import sizing
from brookhouse.operators.latest import keyed_messages, latest_by_key
from brookhouse.sources import jdbc
from tests.conftest import rows


@pytest.fixture
def dictionary(spark):
    return L.dictionary_rows(spark.createDataFrame([("1201", "good")], "rowkey string, dic_name string"))


def test_unknown_rating_drops_the_comment(spark, dictionary):
    names = ["id", "user_id", "nick_name", "head_img", "sku_id", "spu_id", "order_id", "appraise", "comment_txt",
             "create_time", "operate_time"]
    comments = spark.createDataFrame([tuple(a if n == "appraise" else "x" for n in names) for a in ("1201", "9", None)],
                                     ", ".join(f"{n} string" for n in names))
    (row,) = rows(L.comment_facts(comments, dictionary))
    assert (row["appraise_code"], row["appraise_name"]) == ("1201", "good")
    assert "head_img" not in row and len(row) == 11


def test_unknown_payment_type_keeps_the_payment(spark, dictionary):
    paid = spark.createDataFrame([("1201",), ("9",), (None,)], "payment_type string").select(
        "*", *[F.lit("x").alias(c) for c in (
            "id", "order_id", "user_id", "payment_time", "sku_id", "province_id", "activity_id", "activity_rule_id",
            "coupon_id", "sku_name", "order_price", "sku_num", "split_total_amount", "split_activity_amount",
            "split_coupon_amount", "ts")])
    got = {r["payment_type_code"]: r["payment_type_name"] for r in rows(L.payment_facts(paid, dictionary))}
    assert got == {"1201": "good", "9": None, None: None}


def test_small_dictionary_is_broadcast_and_large_is_not(spark, monkeypatch):
    codes = spark.range(1000).select(F.col("id").cast("string").alias("rowkey"))
    facts = spark.range(10).select(F.col("id").cast("string").alias("rowkey"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def joined():
            return sizing.small_join(facts, codes, ["rowkey"], "left")

        def plan():
            return joined()._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan() and joined().count() == 10
        monkeypatch.setattr(sizing, "fits", lambda df: False)
        assert "BroadcastHashJoin" not in plan() and "_part" in plan() and joined().count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("parts", [1, 4])
def test_a_side_that_does_not_fit_is_not_broadcast_by_the_planner_either(spark, monkeypatch, parts):
    codes = spark.range(1000).select(F.col("id").cast("string").alias("rowkey"), "id")
    facts = spark.range(2000).select(F.col("id").cast("string").alias("rowkey"))
    monkeypatch.setattr(sizing, "fits", lambda df: False)
    joined = sizing.small_join(facts, codes, ["rowkey"], parts=parts)
    got = joined.collect()
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert len(got) == 1000 and "Broadcast" not in text and ("_part" in text) == (parts > 1)


def test_sizes_are_weighed_without_gathering_rows(spark):
    codes = spark.range(1000).select(F.col("id").cast("string").alias("rowkey"))
    assert sizing.fits(codes) and not sizing.fits(codes, max_rows=999) and not sizing.fits(codes, max_bytes=100)


def test_materialised_rows_are_read_back(spark):
    df = spark.range(5).withColumn("m", F.create_map(F.lit("a"), F.col("id")))
    got = sizing.materialise(df)
    assert got.dtypes == df.dtypes and rows(got) == rows(df)
    assert sizing.scratch_dir(spark) in got.inputFiles()[0]


def test_latest_and_deletes(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q"), ("b", 2, None)],
                                "k string, seq int, v string")
    assert [r["v"] for r in rows(latest_by_key(log, ["k"], F.col("seq")))] == ["z", None]
    assert [r["k"] for r in rows(latest_by_key(log, ["k"], F.col("seq"), F.col("v").isNull()))] == ["a"]


def test_keyed_messages(spark):
    (row,) = rows(keyed_messages(spark.createDataFrame([("1", None, 2)], "id string, n string, ts int"), ["id"]))
    assert row == {"key": '{"id":"1"}', "value": '{"id":"1","ts":2}'}


class FakeReader:
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
        return self


def test_jdbc_options():
    class Session:
        read = FakeReader()
    seen = jdbc.read_table(Session, "jdbc:x", "t", {"user": "u"}, "id", (0, 100), 4).seen
    assert seen == {"format": "jdbc", "url": "jdbc:x", "dbtable": "t", "user": "u", "partitionColumn": "id",
                    "lowerBound": 0, "upperBound": 100, "numPartitions": 4}
