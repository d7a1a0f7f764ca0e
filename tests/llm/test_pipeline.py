"""Each stage of the pipeline on its own input, and the whole run."""

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_shrink(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == columns
        assert 0 < docs.count() <= kept
        kept = docs.count()
    assert corpus_pipeline.mix_sources(spark, docs, SMALL).count() > 0


def test_run_repeats(spark):
    once = corpus_pipeline.run(spark, SMALL).select("doc_id").collect()
    assert sorted(once) == sorted(corpus_pipeline.run(spark, SMALL).select("doc_id").collect())
