from collections import Counter

import pytest

from brookhouse.llm import decontaminate
from brookhouse.llm.decontaminate import clean_documents, leaks
from tests.llm.test_words import words


def similarity(a, b, k):
    def bag(w):
        return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    x, y = bag(a), bag(b)
    weigh = lambda c: sum(n * len("".join(s)) for s, n in c.items())
    return weigh(x & y) / weigh(x | y)


def brute(rows, items):
    """The best item-sized window of each document, over all its places."""
    out = {}
    for doc, text in rows:
        w = words(text)
        for item, own in items:
            v = words(own)
            if not v or len(w) < min(5, len(v)):
                continue
            best = max(similarity(w[s : s + len(v)], v, min(5, len(v))) for s in range(len(w) - min(5, len(v)) + 1))
            if best >= 0.8:
                out[doc, item] = max(round(best, 6), out.get((doc, item), 0))
    return out


@pytest.fixture
def bench(spark):
    return lambda *rows: spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("small", [100_000, 0])
def test_equals_brute_force(spark, docs, bench, prose, monkeypatch, small):
    monkeypatch.setattr(decontaminate, "SMALL", small)
    items = [(k, prose(15 + 5 * k, k, 5000)) for k in range(8)] + [(20, "short one"), (21, "a b a b a b a b a b a b")]
    rows = [(k, prose(80, 100 + k, 5000)) for k in range(10)]
    rows += [(20 + k, f"{prose(40, 200 + k, 5000)} {items[k][1].upper()}\n {prose(30, 300 + k, 5000)}") for k in range(8)]
    near = items[5][1].split()
    rows += [(40, " ".join([*near[:10], "changed", *near[11:]])), (41, " ".join(near[: len(near) // 2])), (42, " ".join([*near[:7], *near[9:], "x y"]))]
    rows += [(50, "it has a Short   one in it"), (51, items[0][1]), (52, "a b a b a b a b a b a b a b"), (53, f"{items[1][1]} {items[1][1]} {items[2][1]}")]
    found = {(r.doc_id, r.item_id): r.similarity for r in leaks(docs(*rows), bench(*items)).collect()}
    assert found == pytest.approx(brute(rows, items))


def test_edge_cases(spark, docs, bench, prose):
    item = prose(30, 1, 5000)
    df = docs((1, None), (2, ""), (3, item), (3, item), (None, item), (5, prose(20_000, 2, 5000) + " " + item)).withColumnsRenamed({"source": "item", "lang": "n"})
    b = bench((None, item), (7, item.upper()), (8, None), (9, " \n "), (7, item))
    rows = sorted((r.doc_id or 0, r.item_id, r.similarity, r.start, r.n_words) for r in leaks(df, b).collect())
    assert rows == [(0, 7, 1.0, 0, 30), (3, 7, 1.0, 0, 30), (5, 7, 1.0, 20_000, 30)]
    out = clean_documents(df, b)
    assert out.columns == df.columns and sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 2]
    assert leaks(df, b.limit(0)).count() == 0 and clean_documents(df, b.limit(0)).count() == 6
    assert leaks(df.limit(0), b).count() == 0


def test_no_python_runs(spark, docs, bench, prose):
    plan = clean_documents(docs(prose(50, 1)), bench((1, prose(20, 2))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("small", [100_000, 0])
def test_anchors_away_from_their_own_offset(spark, docs, bench, monkeypatch, small):
    """All anchors lie in the middle of the item; the best window holds them shifted by words put in and left out."""
    monkeypatch.setattr(decontaminate, "SMALL", small)
    item = [f"{i:03d}{'abc' if 22 <= i <= 77 else 'de'}" for i in range(100)]
    tail = [f"z{i:03d}" for i in range(60)]
    shifted = [*item[:10], "put1x", "put2x", *item[10:87], *item[89:]]
    swapped = [*item[50:], *item[:50]]
    rows = [(1, " ".join([*tail[:30], *shifted, *tail[30:]])), (2, " ".join([*tail, *swapped])), (3, " ".join([*item[5:], *tail])),
            (4, " ".join([*tail, *item[:95]])), (5, " ".join([*item[:50], *tail[:30], *item[50:]]))]
    items = [(1, " ".join(item)), (2, " ".join([*item, *tail[:5]]))]
    want = brute(rows, items)
    assert {(1, 1), (2, 1)} <= want.keys() and not any(doc == 5 for doc, _ in want)
    assert {(r.doc_id, r.item_id): r.similarity for r in leaks(docs(*rows), bench(*items)).collect()} == pytest.approx(want)


@pytest.mark.parametrize("small", [100_000, 0])
def test_texts_without_or_with_equal_ids(spark, docs, bench, prose, monkeypatch, small):
    monkeypatch.setattr(decontaminate, "SMALL", small)
    item, other = prose(30, 1, 5000), prose(30, 2, 5000)
    df = docs((None, f"x y {item}"), (None, f"x {other}"), (None, None), (3, f"{prose(40, 3, 5000)} {item}"), (3, prose(90, 4, 5000)), (3, f"x {other}"), (3, f"x {other}"))
    rows = sorted((r.doc_id or 0, r.item_id, r.similarity, r.start) for r in leaks(df, bench((1, item), (2, other))).collect())
    assert rows == [(0, 1, 1.0, 2), (0, 2, 1.0, 1), (3, 1, 1.0, 40), (3, 2, 1.0, 1)]
