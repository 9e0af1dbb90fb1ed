import numpy as np
import pyarrow as pa
import pytest

from brookhouse.llm import languages as L
from tests.conftest import SF


@pytest.mark.parametrize("segment", [1, 4, 128])
def test_posteriors_are_those_of_the_whole_chain(monkeypatch, segment):
    monkeypatch.setattr(L, "SEGMENT", segment)
    r = np.random.default_rng(1)
    scores, move = r.standard_normal((60, 3)).astype(np.float32) * 2, r.standard_normal((3, 3))
    counts = np.array([30, 1, 7, 22])
    got, at = L.posteriors(scores, counts, move), 0
    for n in counts:
        p, m = np.exp(scores[at : at + n].astype(float)), np.exp(move)
        ahead = [(np.full(3, 1 / 3) @ m) * p[0]]
        for t in range(1, n):
            ahead.append((ahead[-1] @ m) * p[t])
        behind = [np.ones(3)]
        for t in range(n - 1, 0, -1):
            behind.append(m @ (p[t] * behind[-1]))
        want = np.array(ahead) * np.array(behind[::-1])
        assert np.allclose(got[at : at + n], want / want.sum(axis=1, keepdims=True), atol=1e-6)
        at += n


@pytest.fixture(scope="module")
def field(spark):
    return L.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = L.op6_languages(spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 20
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_code_switched_text(spark, docs, field):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("lang in ('de', 'fr') and n_chars > 600").collect()
    de, fr = (next(r.text for r in rows if r.lang == x) for x in ("de", "fr"))
    de, fr = " ".join(de.split()[:60]), " ".join(fr.split()[:40])
    (r,) = L.languages(docs(f"{de} {fr}"), field).collect()
    assert r.lang_pred == "de" and r.score < 0.8
    label = [s.lang for s in r.spans for _ in range(s.words)]
    assert len(label) == 100 and np.mean([x == ("de" if k < 60 else "fr") for k, x in enumerate(label)]) > 0.9


def test_edge_cases(spark, docs, field, prose):
    df = docs((1, None), (2, ""), (3, "12 34 !!"), (4, "¿…— 字"), (5, "…—"), (6, "the of and"), (6, "the of and"), (None, "the"), (8, prose(30_000, 1))).withColumnRenamed("source", "score")
    got = {r.doc_id: r for r in L.languages(df, field).collect()}
    assert L.languages(df, field).count() == 9
    for i in (1, 2, 3, 5):
        assert (got[i].lang_pred, got[i].score, got[i].spans) == ("und", 0.0, [])
    assert all(got[i].lang_pred in field.languages for i in (4, 6, None, 8)) and sum(s.words for s in got[8].spans) == 30_000
    assert {r.lang_pred for r in L.languages(df, None).collect()} == {"und"}
    assert L.languages(df.limit(0), field).count() == 0
    assert L.train(df) is None and L.train(docs("x").limit(0)) is None


def test_features_of_a_word_do_not_depend_on_its_neighbours(field):
    words = pa.array([b"one", b"\xc3\xa9t\xc3\xa9", b"zz", b"x", b"12", b"one"], pa.binary())
    ids, begins = L.features(words, field.lexicon)
    each = [sorted(ids[a:b].tolist()) for a, b in zip(begins[:-1], begins[1:], strict=True)]
    assert each[0] == each[5] and each[0] and each[4] == []
    alone = [sorted(L.features(words.slice(k, 1), field.lexicon)[0].tolist()) for k in range(6)]
    assert alone == each


@pytest.mark.parametrize("counts", [[6], [1, 4, 1], [3, 200]])
def test_gradient_equals_finite_differences(monkeypatch, counts):
    monkeypatch.setattr(L, "SEGMENT", 4)
    r = np.random.default_rng(len(counts))
    counts = np.array(counts)
    n, states = int(counts.sum()), 3
    scores, move, true = r.standard_normal((n, states)), r.standard_normal((states, states)), r.integers(0, states, n)

    def loss(scores, move):
        total, at = 0.0, 0
        for size in counts:
            every = np.logaddexp.reduce(move, axis=0) - np.log(states) + scores[at]
            own = every[true[at]]
            for t in range(at + 1, at + size):
                every = np.logaddexp.reduce(every[:, None] + move, axis=0) + scores[t]
                own += move[true[t - 1], true[t]] + scores[t, true[t]]
            total += np.logaddexp.reduce(every) - own
            at += size
        return total

    by_score, by_move = L.loss_gradient(scores, counts, true, move)
    for grad, value, f in ((by_move, move, lambda x: loss(scores, x)), (by_score[:8], scores, lambda x: loss(x, move))):
        for i, j in np.ndindex(grad.shape):
            step = np.zeros_like(value)
            step[i, j] = 1e-5
            assert grad[i, j] == pytest.approx((f(value + step) - f(value - step)) / 2e-5, abs=1e-4)


def test_a_rare_language_is_learned_and_the_sample_is_bounded(spark, docs, monkeypatch):
    rows = [(k, f"the common words of text {k} " * 5, "en", None) for k in range(400)] + [(k, f"seldene wörter nummer {k} " * 5, "de", None) for k in range(400, 404)]
    rows += [rows[0]] * 5 + [(500, "x " * 60_000, "zz", None)]
    taught = {}
    monkeypatch.setattr(L, "fit", lambda texts, languages: taught.update(texts=texts, languages=languages))
    L.train(docs(*rows), 20)
    assert taught["languages"].count("en") == 20 and 1 <= taught["languages"].count("de") <= 4 and "zz" not in taught["languages"]
    assert len(set(taught["texts"])) == len(taught["texts"])
