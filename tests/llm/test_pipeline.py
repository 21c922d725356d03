import corpus_pipeline
from daybook.sources.store import materialize


def test_stages_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf), "test")
        if name != "byte_bpe":
            assert docs.dtypes == before.dtypes
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= first
    assert docs.count() and docs.where("n_tokens <> size(ids) OR text RLIKE '@mail'").count() == 0


def test_near_duplicates_keep_one_row(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text), (2, text + " x"), (2, text + " x"), (5, None), (6, ""), (None, "other words " * 3)]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, key string")
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.where("text IS NOT NULL").collect()) == [(0, "other words " * 3), (2, text + " x"), (6, "")]
    assert got.where("text IS NULL").count() == 1
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0
