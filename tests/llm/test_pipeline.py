import corpus_pipeline

import __spark_entry__
from millrace.llm import decontaminate, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "decontaminate", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, sf)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert out.columns == COLUMNS and out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
            assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in before.collect()}
            assert out.filter("n_chars <> length(text)").count() == 0
        if name == "quality_rules":
            assert quality.keep_good(spark, out, sf).count() == out.count() < before.count()
        if name == "decontaminate":
            again = decontaminate.find_contamination(out, spark.read.parquet(f"{sf}/benchmark.parquet"))
            assert again.filter(decontaminate.contaminated()).count() == 0
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in before.collect()}
        before = out
    assert corpus_pipeline.run(spark, sf).count() == before.count()


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} >= set(range(1, 11))
