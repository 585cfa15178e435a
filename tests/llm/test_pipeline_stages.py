import corpus_pipeline
from bidlake.llm import decontam
from tests.conftest import SF01
from tests.llm import awkward
from tests.llm.test_neardup import brute


def test_stages_over_documents(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_duplicates", "decontamination", "mixing"]
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, SF01))
        rows[name] = docs.count()
        if name != "mixing":
            assert docs.columns == columns and 0.8 * before.count() <= rows[name] <= before.count()
        if name == "near_duplicates":
            texts = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert {r["doc_id"] for r in docs.collect()} == {d for d, c in brute(texts, 5, 80).items() if d == c}
        if name == "toxicity":
            kept = {r["doc_id"] for r in docs.collect()}
            truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
            clean = [d for d in (r["doc_id"] for r in before.collect()) if truth.get(d) == 0]
            assert sum(d in kept for d in clean) >= 0.97 * len(clean)
        if name == "decontamination":
            items = [decontam.normalised(r["text"]) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
            assert not any(t in decontam.normalised(r["text"]) for r in docs.collect() for t in items)
    assert rows["mixing"] == rows["decontamination"] and docs.columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_awkward_rows(spark, tmp_path):
    awkward.labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "quick brown fox jumps over")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (awkward.documents(spark), awkward.no_documents(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)))
            if name != "mixing":
                assert docs.columns == columns
        docs.collect()


def test_run_is_the_registered_query(spark):
    import __spark_entry__ as E
    assert E.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.ORACLE_SQL is None
