import random

import pytest

from brookhouse.llm import minhash
from brookhouse.llm.minhash import distinct_documents, match_threshold, near_duplicates
from tests.llm.test_words import words


def brute(rows, n, percent):
    sets = {}
    for i, text in rows:
        w = words(text)
        sets.setdefault(i, set()).update(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1)) if w)
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((label[a], label[b]))
                label = {i: x if v == y else v for i, v in label.items()}
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def edited(text, changes, seed):
    w, r = text.split(), random.Random(seed)
    for _ in range(changes):
        w[r.randrange(len(w))] = f"x{r.random()}"
    return " ".join(w)


@pytest.mark.parametrize(("block", "size"), [(2048, 500_000), (8, 600)])
def test_components_equal_brute_force(spark, docs, prose, monkeypatch, block, size):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", size)
    rows = [prose(150, k) for k in range(20)] + [prose(150, 0)] * 15
    rows += [edited(prose(150, 1), k % 7, k) for k in range(40)]  # a large group, some too far from the others
    rows += [prose(60, 99) + " " + prose(200, 500 + k) for k in range(20)]  # a passage in common
    rows = list(enumerate(rows))
    random.Random(1).shuffle(rows)
    assert got(near_duplicates(docs(*rows), 3, 85)) == brute(rows, 3, 85)


def test_edge_cases(spark, docs, prose):
    long = prose(20_000, 5)
    rows = [(0, None), (1, ""), (2, " \n"), (3, "One two"), (4, "one  TWO"), (5, "one two three"), (6, long), (7, long + " end"), (7, long + " end"), (8, "one two")]
    result = near_duplicates(docs(*rows, (None, "one two")), 3, 85).collect()
    assert len(result) == 11
    assert [(r.n_shingles, r.component_id, r.kept) for r in result if r.doc_id is None] == [(1, None, True)]
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in result if r.doc_id is not None} == brute(rows, 3, 85)
    assert near_duplicates(docs(*rows[:0]), 3, 85).count() == 0


def test_stage_keeps_one_of_a_group_and_all_columns(spark, docs, prose):
    text = prose(100, 3)
    df = docs((1, prose(80, 4), "en", "a"), (5, text), (3, text), (9, edited(text, 1, 1))).selectExpr("*", "1 as component_id", "2 as kept", "3 as rep")
    out = distinct_documents(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_threshold_is_rarely_missed():
    from math import comb

    for percent in (80, 85, 95):
        t, p = match_threshold(percent), percent / 100
        assert sum(comb(32, k) * p**k * (1 - p) ** (32 - k) for k in range(t)) <= minhash.MISS
