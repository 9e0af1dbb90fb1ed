import pytest

from brookhouse.functions import dates as D

MS = 1715702400000  # 2024-05-15 00:00:00 +08:00


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def lit(v):
    from pyspark.sql import functions as F
    return F.lit(v)


def test_texts_to_epoch_use_a_fixed_offset(spark):
    assert value(spark, D.datetime_to_ts(lit("2024-05-15 00:00:00"))) == MS
    assert value(spark, D.date_to_ts(lit("2024-05-15"))) == MS
    assert value(spark, D.datetime_to_ts(lit("2024-05-15 00:00:00"), "+00:00")) == MS + 8 * 3600 * 1000
    assert value(spark, D.datetime_to_ts(lit("soon"))) is None


@pytest.mark.parametrize("zone, day, moment, part", [
    (None, "2024-05-14", "2024-05-14 16:00:00", "20240514"),
    ("Asia/Shanghai", "2024-05-15", "2024-05-15 00:00:00", "20240515"),
])
def test_epoch_to_texts(spark, zone, day, moment, part):
    ms = lit(MS)
    assert value(spark, D.ts_to_date(ms, zone)) == day
    assert value(spark, D.ts_to_datetime(ms, zone)) == moment
    assert value(spark, D.ts_to_partition(ms, zone)) == part


def test_session_zone_is_the_default(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert value(spark, D.ts_to_datetime(lit(MS))) == "2024-05-15 00:00:00"
        assert value(spark, D.ts_to_datetime(lit(MS), "UTC")) == "2024-05-14 16:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
