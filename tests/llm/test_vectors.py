import numpy as np
import pytest

from brookhouse.llm import neardup_vectors
from brookhouse.llm.neardup_vectors import linked_vectors, op1_embeddings
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.93):
    good = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, np.float32).astype(float)
        good[i] = (x / np.linalg.norm(x), label)
    links = {i: {j for j in good if j != i and good[i][1] == good[j][1] and len(good[i][0]) == len(good[j][0]) and good[i][0] @ good[j][0] >= cosine} for i in good}
    label = {i: i for i, _, _ in rows if i is not None}
    for _ in label:
        for i in links:
            for j in links[i]:
                label[i] = label[j] = min(label[i], label[j])
    return {i: (len(links.get(i, ())), label[i], label[i] == i) for i in label}


def got(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect() if r.vec_id is not None}


def sample(seed, groups, size, noise, dim=32):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((groups, dim))
    return [(k * 3 + 1, [float(x) for x in np.float32(centres[k % groups] * 1.5 + r.standard_normal(dim) * noise)], int(k % groups % 3)) for k in range(groups * size)]


@pytest.mark.parametrize(("block", "noise"), [(1024, 0.1), (1024, 0.25), (16, 0.2)])
def test_equals_brute_force(spark, monkeypatch, block, noise):
    monkeypatch.setattr(neardup_vectors, "BLOCK", block)
    rows = sample(2, 6, 40, noise)
    rows += [(1000 + k, rows[0][1], rows[0][2]) for k in range(30)]  # exact copies
    a, b = got(linked_vectors(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    assert {i: x[1:] for i, x in a.items()} == {i: x[1:] for i, x in b.items()}
    found, all_links = sum(x[0] for x in a.values()), sum(x[0] for x in b.values())
    assert all(a[i][0] <= b[i][0] for i in b) and found >= 0.995 * all_links > 1000


def test_edge_cases(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, v, None), (4, None, 1), (5, [], 1), (6, [0.0] * 3, 1), (7, [1.0, None, 3.0], 1), (8, [1.0, float("nan"), 3.0], 1),
            (9, [float("inf"), 2.0, 3.0], 1), (10, [1.0, 2.0], 1), (11, [1e-30, 2e-30, 3e-30], 1), (12, v, 2)]
    df = spark.createDataFrame([*rows, (None, v, 1)], SCHEMA).selectExpr("*", "1 as rep", "'x' as bucket")
    out = linked_vectors(df).collect()
    assert len(out) == 14 and [(r.n_links, r.component_id, r.kept) for r in out if r.vec_id is None] == [(0, None, True)]
    assert got(linked_vectors(df)) == brute(rows)
    assert linked_vectors(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(op1_embeddings(spark, SF)) == brute(rows)


def test_large_label_compares_few_pairs_and_finds_links(spark):
    """One label of unrelated vectors with planted pairs just above the bound: what its buckets hold, and recall."""
    r = np.random.default_rng(5)
    base = r.standard_normal((20_000, 64))
    near = base[:4000] / np.linalg.norm(base[:4000], axis=1, keepdims=True)
    across = r.standard_normal((4000, 64))
    across -= (across * near).sum(axis=1, keepdims=True) * near
    across /= np.linalg.norm(across, axis=1, keepdims=True)
    planted = 0.9301 * near + np.sqrt(1 - 0.9301**2) * across
    unit = neardup_vectors._unit(np.concatenate([base, planted]))
    buckets = neardup_vectors._buckets(unit, np.zeros(len(unit), np.int64))
    pairs = sum(int((n * (n - 1) // 2).sum()) for n in (np.unique(column, return_counts=True)[1].astype(np.int64) for column in buckets.T))
    assert pairs < 0.01 * len(unit) * (len(unit) - 1) / 2
    met = (buckets[:4000] == buckets[20_000:]).any(axis=1)
    assert met.mean() > 0.998
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(unit[np.r_[:3000, 20_000:23_000]])]
    out = got(linked_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")))
    assert sum(out[k + 3000][1] == k for k in range(3000)) == int(met[:3000].sum())


def test_vectors_travel_only_where_buckets_are_shared(spark):
    """Unrelated vectors reach no comparison: the tables hold ids."""
    rows = sample(9, 60, 1, 0.0, dim=64)
    out = got(linked_vectors(spark.createDataFrame(rows, SCHEMA)))
    assert out == brute(rows) and all(x == (0, i, True) for i, x in out.items())
