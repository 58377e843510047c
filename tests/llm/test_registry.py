from millrace.llm import registry, scratch


def test_queries_leave_only_what_their_results_read(spark, sf):
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("file:///").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = lambda p: fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p))
    for name in ("op2_sharding", "op7_best_fit_packing", "op9_minhash_dedup", "op4_lm_scoring"):
        marked = scratch.mark()
        out = registry.queries()[name](spark, sf)
        left = [p for p in scratch.since(marked) if there(p)]
        assert 0 < len(left) < len(scratch.since(marked)) or len(scratch.since(marked)) <= 2
        assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count() or name == "op7_best_fit_packing"
