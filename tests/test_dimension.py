import random

import pytest
from pyspark.sql import functions as F

from brookhouse.operators.dimension import fold_cells, fold_maps
from tests.conftest import rows

SCHEMA = "k string, seq int, type string, data map<string,string>"


def fold(spark, events, **kw):
    df = spark.createDataFrame([("k", i, t, d) for i, (t, d) in enumerate(events)], SCHEMA)
    return [{c: r[c] for c in ("n", "m")} for r in rows(fold_cells(df, ["k"], ["n", "m"], F.col("seq"), **kw))]


def test_null_keeps_the_old_cell(spark):
    events = [("insert", {"n": "a", "m": "b"}), ("update", {"n": None, "m": "c"})]
    assert fold(spark, events) == [{"n": "a", "m": "c"}]
    assert fold(spark, events, overwrite_nulls=True) == [{"n": None, "m": "c"}]


def test_delete_clears_the_row(spark):
    assert fold(spark, [("insert", {"n": "a"}), ("delete", {"n": "a"})]) == []
    assert fold(spark, [("insert", {"n": "a"}), ("delete", {}), ("bootstrap-insert", {"m": "b"})]) == [
        {"n": None, "m": "b"}]


def test_a_row_without_cells_does_not_exist(spark):
    assert fold(spark, [("insert", {"n": None})]) == []


def test_missing_type_is_a_put(spark):
    assert fold(spark, [(None, {"n": "a"})]) == [{"n": "a", "m": None}]


@pytest.mark.parametrize("seed", range(3))
def test_equals_replay(spark, seed):
    rnd = random.Random(seed)
    events = [
        (rnd.choice("xyz"), i, rnd.choice(["insert", "update", "update", "delete"]),
         {c: rnd.choice(["1", "2", None]) for c in rnd.sample(["a", "b", "c"], rnd.randint(0, 3))})
        for i in range(60)
    ]
    table = {}
    for k, _, kind, data in events:
        if kind == "delete":
            table.pop(k, None)
        else:
            new = {c: v for c, v in data.items() if v is not None}
            if new or k in table:
                table.setdefault(k, {}).update(new)
    df = spark.createDataFrame(events, SCHEMA).repartition(4)
    wide = {r["k"]: {c: r[c] for c in "abc" if r[c] is not None}
            for r in rows(fold_cells(df, ["k"], ["a", "b", "c"], F.col("seq")))}
    maps = {r["k"]: r["data"] for r in rows(fold_maps(df, ["k"], F.col("seq"))) if r["data"]}
    assert wide == maps == table
