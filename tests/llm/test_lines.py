import hashlib
import random
import re
from collections import defaultdict

import pytest

from brookhouse.llm.lines import LineRuns, deduplicate, op2_lines
from brookhouse.llm.queries import ORACLES
from tests.conftest import SF
from tools.check import connect


def brute(rows):
    keys, out = defaultdict(set), []
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    for i, text in rows:
        for line in (text or "").split("\n"):
            keys[key(line)].add(i)
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or i is None or min(j for j in keys[key(x)] if j is not None) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_equals_brute_force(spark, docs, batches):
    r = random.Random(batches)
    lines = [f"line number {k}" for k in range(30)] + ["short", "", "  LINE number 3\r", "\tline Number 4 ", "été à la plage", "ÉTÉ à la plage"]
    rows = [(3 * i, "\n".join(r.choice(lines) for _ in range(r.randrange(12)))) for i in range(80)] + [(500, None), (501, "")]
    r.shuffle(rows)
    assert got(deduplicate(docs(*rows), batches)) == brute(rows)


def test_edge_cases(spark, docs):
    rows = [(1, "a common line\na common line"), (2, "A COMMON LINE \nother"), (2, "A COMMON LINE \nother"), (None, "a common line"), (3, "x" * 200_000 + "\na common line")]
    df = docs(*rows).withColumnsRenamed({"lang": "pos", "source": "h1"})
    assert got(deduplicate(df)) == brute(rows)
    assert deduplicate(df.limit(0)).count() == 0


def test_a_store_goes_on_and_compacts(spark, docs, tmp_path):
    path, levels = str(tmp_path / "runs"), []
    for k in range(5):
        runs = LineRuns(spark, path, fanout=2, buckets=3)  # as after a restart
        dropped = runs.add(docs((10 * k, f"the common line\nonly line {k}"), (10 * k + 1, f"only line {k}")))
        assert sorted((r.doc_id, r.pos) for r in dropped.collect()) == [*([(10 * k, 0)] if k else []), (10 * k + 1, 0)]
        levels.append(sorted(run["level"] for run in runs.runs))
    assert levels == [[0], [1], [0, 1], [2], [0, 2]]
    plan = runs._table(runs.runs[0])._jdf.queryExecution().toString()
    assert "h1" in plan and runs.batches == 5


def test_query_against_sql(spark):
    want = connect(SF).execute(ORACLES["op2_lines"]).fetchall()
    assert sorted(map(tuple, op2_lines(spark, SF).collect())) == sorted(want)
    assert all(len(r[3]) == 64 for r in want) and hashlib.sha256(b"").hexdigest()
