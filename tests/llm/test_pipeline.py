import corpus_pipeline
from brookhouse.llm.decontaminate import leaks
from brookhouse.llm.minhash import near_duplicates
from brookhouse.llm.queries import QUERIES
from brookhouse.llm.scratch import keep
from tests.conftest import SF


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, keep(stage(spark, docs, SF))
        seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert seen[name] <= {r.doc_id for r in before.select("doc_id").collect()}
        assert name == "tokens" or docs.columns == columns
        if name == "near_duplicates":
            assert near_duplicates(docs).where("not kept").count() == 0
        if name == "decontamination":
            assert leaks(docs, bench).count() == 0 and leaks(before, bench).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "tokens"]
    assert len(seen["near_duplicates"]) < len(seen["quality"]) < 200 and seen["tokens"] == seen["mixing"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in seen["quality"] for i in good) >= 0.97 * len(good)


def test_run_and_registration(spark):
    assert QUERIES["pipeline"] is corpus_pipeline.run
    assert {name.split("_")[0] for name in QUERIES if name != "pipeline"} == {f"op{n}" for n in range(1, 14)}
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 50
