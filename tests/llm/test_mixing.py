import math
from collections import defaultdict

import pytest

from brookhouse.llm import mixing
from brookhouse.llm.mixing import mixed_documents, mixture, temperature


def exponent(totals, budget, fits):
    """Plain bisection on one monotone condition that holds at the returned end."""
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if fits(mid) else (mid, high)
    return high


@pytest.mark.parametrize(("entropy", "repetition"), [(None, 2.0), (None, 1.3), (0.9, None), (0.99, None)])
def test_exponent_equals_plain_bisection(spark, entropy, repetition):
    t = {"a": 10_000, "b": 1000, "c": 300, "d": 0, None: 50}
    total = sum(t.values())
    p = [n / total for n in t.values() if n]

    def weights(a):
        x = [q**a for q in p]
        return [y / sum(x) for y in x]

    got = temperature(spark.createDataFrame(list(t.items()), "source string, t long"), 1.0, entropy, repetition)
    if entropy is None:
        want = exponent(t, 1.0, lambda a: max(w / q for w, q in zip(weights(a), p, strict=True)) <= repetition)
    else:
        want = 1 - exponent(t, 1.0, lambda b: -sum(w * math.log(w) for w in weights(1 - b)) >= entropy * math.log(4))
    assert got == pytest.approx(want, abs=1e-6)


def test_quotas_are_met(spark, docs, prose, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 500)
    rows = [(i, prose(10 + i % 90, i), "en", "big" if i % 10 else f"s{i % 3}") for i in range(600)]
    out = mixture(docs(*rows)).collect()
    assert len(out) == 600
    took, has, most = defaultdict(int), defaultdict(int), defaultdict(int)
    weight = {}
    for r in out:
        assert r.n_tokens == 10 + r.doc_id % 90
        took[r.source] += r.n_tokens * r.copies
        has[r.source] += r.n_tokens
        most[r.source] = max(most[r.source], r.copies)
        weight[r.source] = r.weight
    total = sum(has.values())
    assert sum(weight.values()) == pytest.approx(1) and max(weight[s] * total / has[s] for s in has) <= 2.0001
    for s in has:
        quota = weight[s] * total
        assert quota - 100 <= took[s] <= quota + 1 and most[s] <= 2
    again = {r.doc_id: r.copies for r in mixture(docs(*reversed(rows))).collect()}
    assert again == {r.doc_id: r.copies for r in out}


def test_edge_cases(spark, docs, prose):
    df = docs((1, None, None, None), (2, "", "en", "a"), (3, "one two", "en", "a"), (3, "one two", "en", "a"), (None, "x y z", None, None),
              (4, prose(20_000, 1), "de", "b")).withColumnsRenamed({"lang": "copy", "n_chars": "N"})
    out = mixture(df, 1.0).collect()
    assert len(out) == 6 and all(r.copies >= 0 for r in out)
    stage = mixed_documents(df, 1.0, 1.0)
    assert stage.columns == df.columns and all(r.doc_id is not None for r in stage.collect())
    assert mixture(df.limit(0)).count() == 0 and mixed_documents(df.limit(0), 0.9, 1.0).count() == 0
    blank = mixture(docs(None, ""))
    assert [r.copies for r in blank.collect()] == [0, 0]
    with pytest.raises(ValueError):
        mixture(df, entropy=0.9)


def test_no_python_runs(spark, docs, prose):
    plan = mixed_documents(docs(prose(50, 1)), 0.9, 1.0)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize(("small", "large"), [(7, 1000), (13, 2100)])
def test_the_smallest_source_is_taken_whole(spark, docs, prose, small, large):
    df = docs((1, prose(small, 1), "en", "small"), *((10 + k, prose(large // 10, 2 + k), "en", "large") for k in range(10)), *((30 + k, prose(large // 20, 20 + k), "en", "middle") for k in range(10)))
    assert [r.doc_id for r in mixed_documents(df, 0.9, 1.0).collect() if r.source == "small"] == [1]
    assert {r.copies for r in mixture(df, 0.9, None, 2.0).where("source = 'small'").collect()} == {2}
