"""The pipeline's stages on a small folder of tables."""

import corpus_pipeline
from hourlake.llm import bpe, jaccard, quality


def test_stages(spark, docs, corpus, tmpdir_path):
    docs = docs.drop("note")
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmpdir_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "secret_scans", "source_mixing", "byte_bpe"]
    at, sizes = spark.read.parquet(f"{tmpdir_path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, at, tmpdir_path)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmpdir_path}/stage{i}")
        at = spark.read.parquet(f"{tmpdir_path}/stage{i}")
        sizes.append(at.count())
    kept = {r.doc_id for r in quality.quality_report(docs, labels).where("kept").collect()}
    assert sizes[0] == sum(r[0] in kept for r in corpus) and 0 < sizes[1] < sizes[0] and sizes[2] == sizes[1]
    second = spark.read.parquet(f"{tmpdir_path}/stage1")
    assert jaccard.components(second).where("doc_id <> component_id").count() == 0
    third = spark.read.parquet(f"{tmpdir_path}/stage2")
    assert third.where("text LIKE '%hunter2%'").count() == 0 and third.where("text LIKE '%[SECRET]%'").count() == 1
    digests = {r.decoded_sha256 for r in bpe.bpe_report(third).collect()}
    assert {r.decoded_sha256 for r in at.collect()} <= digests
    ran = corpus_pipeline.run(spark, tmpdir_path)
    assert sorted(map(tuple, ran.collect()), key=repr) == sorted(map(tuple, at.collect()), key=repr)
