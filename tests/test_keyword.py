import pytest
from pyspark.sql import functions as F

from brookhouse import schemas as S
from brookhouse.operators import keyword as K
from brookhouse.sources.bus import json_table
from tests.conftest import rows


def test_only_search_pages(lines):
    def page(**kw):
        return {"common": {"mid": "m"}, "ts": 5, "page": {"last_page_id": "search", "item_type": "keyword",
                                                         "item": "phone", "during_time": 3} | kw}
    raw = lines(page(), page(last_page_id="home"), page(item_type="sku_id"), page(item=None), {"ts": 1})
    assert rows(K.search_keywords(json_table(raw, S.PAGE_INFO))) == [{"keyword": "phone", "ts": 5}]


def words(df, *args, **kw):
    return [r["word"] for r in K.split_keywords(df, "t", *args, **kw).select("word").collect()]


@pytest.fixture
def text(spark):
    return lambda s: spark.createDataFrame([(s,)], "t string")


def test_blanks_and_patterns(text):
    assert words(text("  red  big widget ")) == ["red", "big", "widget"]
    assert words(text("a1-b2"), "regex", r"[a-z]\d") == ["a1", "b2"]
    assert words(text(None)) == [] and words(text("")) == []


def test_dictionary_takes_the_longest_word(spark, text):
    listed = spark.createDataFrame([("茶杯",), ("青花茶杯",), ("水壶",), ("陶艺",)], "w string")
    got = words(text("No7水壶 青花茶杯，陶艺x"), "dictionary", words=listed)
    assert got == ["No7", "水壶", "青花茶杯", "陶艺", "x"]
    assert words(text("杯"), "dictionary", words=listed) == ["杯"]
    assert words(text(None), "dictionary", words=listed) == []


def test_unknown_mode(text):
    with pytest.raises(ValueError):
        words(text("a"), "magic")


def test_tumbling_windows(spark):
    df = spark.createDataFrame([("a", 0), ("a", 9_999), ("a", 10_000), ("b", 5)], "word string, ts long")
    got = [tuple(r.values()) for r in rows(K.count_by_window(df, "10 seconds"))]
    assert sorted(got) == [(0, 10_000, "a", 2), (0, 10_000, "b", 1), (10_000, 20_000, "a", 1)]


def test_counts_are_combined_before_the_shuffle(spark):
    df = spark.range(10).select(F.lit("hot").alias("word"), F.col("id").alias("ts"))
    plan = K.count_by_window(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_a_million_listed_words(spark, text):
    listed = spark.range(1_000_000).select(F.concat(F.lit("w"), F.col("id").cast("string"), F.lit("x")).alias("w"))
    assert words(text("w12xw999999xw1x-zz"), "dictionary", words=listed) == ["w12x", "w999999x", "w1x", "zz"]


def test_tokens_need_no_python(spark, text):
    df = K.split_keywords(text("ab"), "t", "dictionary", words=spark.createDataFrame([("a",)], "w string"))
    assert "Python" not in df._jdf.queryExecution().toString()


def test_smart_gives_up_a_long_word_for_the_next_one(spark, text):
    listed = spark.createDataFrame([("研究",), ("研究生",), ("生命",), ("命",), ("起源",), ("T恤",)], "w string")
    assert words(text("研究生命起源"), "dictionary", words=listed) == ["研究生", "命", "起源"]
    assert words(text("研究生命起源"), "smart", words=listed) == ["研究", "生命", "起源"]
    assert words(text("No7 T恤，茶研究生x-2"), "smart", words=listed) == ["No7", "T恤", "茶", "研究生", "x", "2"]
    assert words(text("茶x"), "smart", words=listed.limit(0)) == ["茶", "x"]
    assert words(text(None), "smart", words=listed) == [] and words(text(""), "smart", words=listed) == []


def test_best_path_equals_all_paths():
    import itertools
    import random

    def paths(text, graph, at=0):
        if at == len(text):
            yield []
            return
        for size in graph.get(at, ()):
            yield from ([(at, size)] + rest for rest in paths(text, graph, at + size))
        yield from paths(text, graph, at + 1)

    r = random.Random(4)
    listed = ["".join(p) for n in (2, 3, 4) for p in itertools.product("甲乙", repeat=n) if r.random() < 0.4]
    for _ in range(200):
        text = "".join(r.choice("甲乙") for _ in range(r.randrange(1, 11)))
        graph = {i: [len(w) for w in listed if text.startswith(w, i)] for i in range(len(text))}

        def worth(path):
            return sum(n for _, n in path), -len(path), -sum(n * n for _, n in path)

        top = max(map(worth, paths(text, graph)))
        edges = [(i + 1, n) for i, sizes in graph.items() for n in sizes]
        got = K.best_path(text, [i for i, _ in edges], [n for _, n in edges])
        assert "".join(got) == text
        taken = [w for w in got if len(w) > 1]
        assert (sum(map(len, taken)), -len(taken), -sum(len(w) ** 2 for w in taken)) == top


def test_long_texts_take_time_in_proportion(spark, text):
    import time

    listed = spark.createDataFrame([("ab",), ("ba",), ("茶茶",)], "w string")
    words(text("ab茶茶"), "smart", words=listed), words(text("ab茶茶"), "dictionary", words=listed)
    for mode in ("smart", "dictionary"):
        began = time.monotonic()
        assert len(words(text("ab-茶茶 " * 8000), mode, words=listed)) == 16_000
        assert time.monotonic() - began < 15
