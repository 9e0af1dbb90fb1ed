from pyspark.sql import functions as F

from brookhouse.functions.jsons import exact_amounts
from brookhouse.operators.changes import cells, changes_of, clean_changes, parse_changes, with_times
from tests.conftest import rows

GOOD = {"database": "shop", "table": "t", "type": "insert", "ts": 7, "data": {"id": 1, "note": None}}


def change(**kw):
    return GOOD | kw


def test_clean_keeps_changes_of_one_database(lines):
    raw = lines(
        GOOD,
        change(type="bootstrap-insert"),
        {k: v for k, v in GOOD.items() if k != "type"},
        change(type="bootstrap-start"), change(type="bootstrap-complete"),
        change(database="other"), change(data={}), change(data=None), change(data="text"),
        "", None, "garbage", '{"database":"shop"', "[1]", "null", '{"database":"shop"} tail',
    )
    got = rows(clean_changes(raw, "shop").select("type", *cells("id", "note")))
    assert sorted((str(r["type"]), r["id"]) for r in got) == [("None", "1"), ("bootstrap-insert", "1"), ("insert", "1")]


def test_parse_drops_only_what_is_no_object(lines):
    raw = lines(GOOD, {}, change(database="other"), change(type="bootstrap-start"), change(data="text"), "", None,
                "garbage", "[1]", '"text"', "null", "{} {")
    got = rows(parse_changes(raw).select("database", "type", F.size("data").alias("n")))
    assert len(got) == 5
    assert {"database": "shop", "type": "insert", "n": -1} in got or {"database": "shop", "type": "insert", "n": None} in got


def test_time_is_read_from_numbers_and_texts(lines):
    got = parse_changes(lines(change(ts=12), change(ts="13"), change(ts="x"))).select("ts").collect()
    assert sorted(str(r.ts) for r in got) == ["12", "13", "None"]


def test_event_time_and_bus_columns(spark, lines):
    raw = lines(GOOD).withColumn("offset", F.lit(5))
    got = with_times(parse_changes(raw)).select("offset", F.unix_seconds("row_time").alias("s"), "proc_time").first()
    assert (got.offset, got.s) == (5, 7) and got.proc_time is not None


def test_changes_of_and_cells(lines):
    raw = lines(GOOD, change(table="u"), change(type="update"), change(type="delete"))
    got = changes_of(parse_changes(raw), "shop", "t", "insert", "update").select("type", *cells("id", number="id"))
    assert [tuple(r.values()) for r in rows(got)] == [("insert", "1", "1"), ("update", "1", "1")]


def test_skipping_other_tables_changes_nothing_else(lines):
    raw = lines(GOOD, change(table="u", data={"id": 't"t'}), change(table="u"))
    assert [r["table"] for r in rows(parse_changes(raw, ("t",)).filter("`table` = 't'"))] == ["t"]
    assert parse_changes(raw, ("nothing",)).count() == 0


def test_a_line_is_parsed_once(lines):
    plan = clean_changes(lines(GOOD), "shop").select(*cells("id"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_exact_amounts(lines):
    raw = lines('{"data":{"price":2899.00,"big":12345678901234567.50}}')
    got = raw.select(exact_amounts(F.col("value"), "price", "big").alias("a")).select("a.*").first()
    assert (str(got.price), str(got.big)) == ("2899.00", "12345678901234567.50")
