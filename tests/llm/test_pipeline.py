"""The pipeline's stages on a small table, against the operators' own brute-force rules."""

import corpus_pipeline
from tests.conftest import SF_SMALL


def test_stages_over_the_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, frame = frame, corpus_pipeline.staged(stage(spark, frame, SF_SMALL), f"test-{name}")
        assert frame.columns == columns, name
        ids = {r.doc_id for r in frame.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and len(ids) >= 0.5 * before.count()
        if name == "substrings":
            assert len(ids) == before.count() and frame.where("n_chars != length(text)").count() == 0
    last = corpus_pipeline.encode(spark, frame, SF_SMALL)
    assert last.count() == frame.count() and "ids" in last.columns
    assert sorted(last.columns) == sorted(corpus_pipeline.run(spark, SF_SMALL).columns)


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF_SMALL), "test-empty")
        assert docs.count() == 0
