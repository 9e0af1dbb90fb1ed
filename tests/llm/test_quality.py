import numpy as np
import pyarrow as pa
import pytest

from brookhouse.llm import quality
from brookhouse.llm.quality import good_documents, score, train
from brookhouse.llm.words import text_slices

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.op7_quality(spark, SF).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert len(rows) > 50 and np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.97
    assert quality.op7_quality(spark, SF).count() == docs.count()


def test_gradient_is_that_of_the_loss():
    r = np.random.default_rng(0)
    bags = [r.random((n, quality.WIDTH)).astype(np.float32) for n in (1, 3, 2)]
    labels = np.array([1, 0, 1], np.float32)
    before = quality.fit(bags, labels, epochs=1)
    after = quality.fit(bags, labels, epochs=60)
    begins = np.array([0, 1, 4, 6])

    def loss(m):
        p = quality._forward(m, np.concatenate(bags), begins)[-1]
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    assert loss(after) < 0.2 * loss(before)


def test_passages_cover_the_whole_text():
    text = " ".join(["word"] * 1000)
    (t,) = text_slices(pa.array([text, None, "", "x"]))
    x, begins = quality.passages(t)
    assert np.diff(begins).tolist() == [16, 1, 1, 1] and x.shape[0] == 19
    assert (x[16:18] == 0).all() and x[18].max() > 0.1


def test_edge_cases(spark, docs, prose):
    df = docs((1, None), (2, ""), (2, ""), (None, prose(50, 1)), (4, prose(30_000, 2))).withColumnsRenamed({"source": "Score"})
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, None), (2, None, 0), (4, 0, 1), (4, 1, 1), (3, 7, 0)], "doc_id long, quality int, toxic int")
    out = good_documents(df, labels)
    assert out.columns == df.columns and out.count() <= 5
    assert train(df, labels.limit(0)) is None
    assert {r.s for r in score(df, None, "s").collect()} == {0.5}
    assert score(df.limit(0), None, "s").count() == 0
    assert train(df.limit(0), labels) is None


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_labels_of_one_kind(share):
    m = quality.fit([np.ones((2, quality.WIDTH), np.float32)] * 4, np.full(4, share, np.float32), epochs=2)
    assert np.isfinite(quality._forward(m, np.ones((2, quality.WIDTH), np.float32), np.array([0, 2]))[-1]).all()
