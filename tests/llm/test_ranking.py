import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from brookhouse.llm.ranking import OP13_SQL, best, op13_search, rank
from tests.conftest import SF
from tools.check import connect

ITEMS = "item_id long, text string, rank int, score string"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, top):
    tfs = [(i, Counter(terms(text))) for i, text in docs]
    tfs = [(i, tf) for i, tf in tfs if tf]
    n_docs, total = len(tfs), sum(sum(tf.values()) for _, tf in tfs)
    df = Counter(t for _, tf in tfs for t in tf)
    out = []
    for item, text in items:
        scored = []
        for i, tf in tfs:
            m = 75 + (25 * sum(tf.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in terms(text) if t in tf)
            if score > 0:
                scored.append((-score, i is None, i, score))
        out += [(item, k, i, score) for k, (_, _, i, score) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:top], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def corpus(seed, n):
    r = random.Random(seed)
    vocabulary = [f"t{k}" for k in range(60)] + ["Été", "été", "ABC", "abc", "x1y2"]
    draw = lambda most: r.choice([" ", "-", "\n", ", "]).join(r.choices(vocabulary, [1 / (k + 1) for k in range(len(vocabulary))], k=r.randrange(most)))
    return [(3 * k, draw(60)) for k in range(n)], [(k, draw(12)) for k in range(15)]


@pytest.mark.parametrize(("n", "top", "block_bytes"), [(300, 5, 1 << 20), (40, 20, 60), (90, 1, 100)])
def test_equals_brute_force(spark, docs, n, top, block_bytes):
    rows, items = corpus(n, n)
    random.Random(1).shuffle(rows)
    found = rank(docs(*rows).repartition(3), spark.createDataFrame([(*x, 0, "") for x in items], ITEMS), top, block_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and got(found) == brute(rows, items, top)


def test_edge_cases(spark, docs):
    rows = [(1, "same words here"), (2, "same words here"), (2, "same words here"), (None, "same words here"), (3, None), (4, ""), (5, " .,;\x00 "),
            (6, "long " * 50_000 + "words"), (-7, "İ SAME straße")]
    items = [(1, "words, words; same"), (1, "words, words; same"), (1, "here"), (None, "same"), (2, None), (3, "--"), (4, "absent"), (5, "Straße")]
    df = docs(*rows).withColumnsRenamed({"lang": "terms", "source": "item"})
    table = spark.createDataFrame([(*x, 0, "") for x in items], ITEMS)
    assert got(rank(df, table)) == brute(rows, items, 20)
    assert rank(df.limit(0), table).count() == 0 and rank(df, table.limit(0)).count() == 0


def test_skipping_finds_the_same(monkeypatch):
    r = np.random.default_rng(5)
    monkeypatch.setattr("brookhouse.llm.ranking.STRIDE", 16)
    for _ in range(200):
        n = int(r.integers(1, 400))
        lists = []
        for _ in range(int(r.integers(0, 7))):
            own = np.flatnonzero(r.random(n) < r.choice([0.01, 0.2, 0.9]))
            lists.append((own, r.integers(0, int(r.choice([2, 50])), len(own))))
        sums = np.zeros(n, np.int64)
        for own, adds in lists:
            sums[own] += adds
        order = np.lexsort((np.arange(n), -sums))
        order = order[sums[order] > 0][:4]
        found, scores = best(lists, n, 4)
        assert found.tolist() == order.tolist() and scores.tolist() == sums[order].tolist()


def test_query_against_sql(spark):
    want = connect(SF).execute(OP13_SQL).fetchall()
    assert len(want) > 100 and sorted(map(tuple, op13_search(spark, SF).collect())) == sorted(want)
