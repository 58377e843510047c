"""The corpus pipeline: five stages, each written and read again as the next one's input.

quality rules -> MinHash near-dedup -> substring dedup -> benchmark
decontamination -> best-fit packing.  The first four return the columns of
``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, near_dedup, packing, quality, scratch, substring_dedup


_kept: list[str] = []


def _stage(f):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        scratch.drop(spark, _kept)  # ``docs`` is written, so what the stage before kept is not needed
        marked = scratch.mark()
        out = f(spark, docs, sf_dir)
        _kept[:] = scratch.since(marked)
        return out

    return run_stage


STAGES = [
    ("quality_rules", _stage(quality.keep_good)),
    ("near_dedup", _stage(near_dedup.keep_one)),
    ("substring_dedup", _stage(substring_dedup.cut_repeats)),
    ("decontaminate", _stage(decontaminate.drop_contaminated)),
    ("packing", _stage(packing.pack_documents)),
]

#: Near-dedup, chaining and packing have no SQL form; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
