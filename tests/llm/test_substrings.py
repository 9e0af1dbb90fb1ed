import random
import re

import numpy as np
import pyarrow as pa
import pytest

from brookhouse.llm.sketch import Sketch, cells_for, maybe_repeated
from brookhouse.llm.substrings import OP12_SQL, deduplicate, op12_substrings
from brookhouse.llm.windows import plain_hashes, windows
from brookhouse.llm.words import text_slices
from tests.conftest import SF
from tools.check import connect


def brute(rows, window):
    """Directly from the definition: a window goes if it starts in a smaller doc_id or earlier in its own text."""
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text in rows]
    where = {}
    for i, own in words:
        for s in range(len(own) - window + 1):
            if i is not None:
                where.setdefault(tuple(own[s : s + window]), set()).add(i)
    out = []
    for i, own in words:
        gone, seen = set(), set()
        for s in range(len(own) - window + 1):
            key = tuple(own[s : s + window])
            if i is not None and (key in seen or min(where[key]) < i):
                gone.update(range(s, s + window))
            seen.add(key)
        out.append((i, len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def passages():
    r = random.Random(3)
    common = [" ".join(f"{r.choice('abcdeé')}{r.randrange(40)}" for _ in range(r.randrange(4, 40))) for _ in range(12)]
    rows = []
    for k in range(120):
        parts = [r.choice(common) if r.random() < 0.5 else " ".join(f"x{r.randrange(9)}" for _ in range(r.randrange(12))) for _ in range(r.randrange(6))]
        rows.append((2 * k, r.choice([" ", "\n", " \t "]).join(parts)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("window", "anchor", "cells"), [(6, 3, None), (6, 6, None), (6, 1, 8), (20, 10, None), (2, 1, 1 << 10)])
def test_equals_brute_force(spark, docs, passages, window, anchor, cells):
    """Also with a sketch so small that it holds nothing back."""
    assert got(deduplicate(docs(*passages).repartition(3), window, anchor, cells)) == brute(passages, window)


def test_edge_cases(spark, docs):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [
        (5, text), (5, text), (5, "start " + text), (9, text + "\nend"), (None, text), (None, text), (1, None), (2, ""), (3, " \n\t"),
        (4, "a " * 5000), (6, " ".join(f"w{k}" for k in range(19))), (7, "W0 " + text), (8, text.upper()), (-3, "only " * 20),
    ]
    df = docs(*rows).withColumnsRenamed({"lang": "h1", "source": "firsts"})
    assert got(deduplicate(df)) == brute(rows, 20)
    assert deduplicate(df.limit(0)).count() == 0


def test_a_group_of_copies_keeps_one(spark, docs, prose):
    rows = [(k, prose(60, 1) + f" end{k}") for k in range(300)]
    assert got(deduplicate(docs(*rows).repartition(8))) == brute(rows, 20)


def test_words_hash_alike_wherever_they_stand():
    a, b = (next(text_slices(pa.array(x))) for x in (["on  two\nthree", "Two two"], ["three two Two"]))
    ha, hb = plain_hashes(a), plain_hashes(b)
    assert ha[1] == ha[4] == hb[1] and ha[2] == hb[0] and ha[3] == hb[2] and ha[3] != ha[4]


def test_marks_count_no_window_too_low():
    r = random.Random(8)
    for _ in range(40):
        texts = [" ".join(r.choice("abc") for _ in range(r.randrange(30))) for _ in range(3)]
        w = windows(next(text_slices(pa.array(texts))), 5, 2)
        for key in set(w.h1.tolist()):
            own = w.h1 == key
            assert len(set(w.anchors[own].tolist())) == 1
            assert (w.marks == w.anchors[own][0]).sum() >= own.sum()


def test_sketch_never_estimates_too_low():
    r = np.random.default_rng(1)
    once, twice = r.integers(1, 2**63, 3000, dtype=np.uint64), r.integers(1, 2**63, 500, dtype=np.uint64)
    sketch = Sketch(1 << 17)
    sketch.add(np.concatenate([once, twice[:200]]))
    sketch.add(np.concatenate([twice, twice[200:]]))
    assert maybe_repeated(sketch.again, twice).all()
    assert maybe_repeated(sketch.again, once).mean() < 0.01
    assert cells_for(0) == 1 << 16 and cells_for(10**15) == 1 << 30


def test_query_against_sql(spark):
    want = connect(SF).execute(OP12_SQL).fetchall()
    assert sorted(map(tuple, op12_substrings(spark, SF).collect())) == sorted(want)
