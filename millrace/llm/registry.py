"""The queries of this package and, where SQL can express them, their oracles."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, html_extract, license_scan, lm_score, near_dedup, packing, quality, scratch, sharding, substring_dedup, toxicity


def _tidied(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        marked = scratch.mark()
        return scratch.tidy(query(spark, sf_dir), marked)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_sharding": sharding.op2_sharding,
        "op3_substring_dedup": substring_dedup.op3_substring_dedup,
        "op4_lm_scoring": lm_score.op4_lm_scoring,
        "op5_html_extract": html_extract.op5_html_extract,
        "op6_quality_rules": quality.op6_quality_rules,
        "op7_best_fit_packing": packing.op7_best_fit_packing,
        "op8_decontaminate": decontaminate.op8_decontaminate,
        "op9_minhash_dedup": near_dedup.op9_minhash_dedup,
        "op10_license_scan": license_scan.op10_license_scan,
    }
    return {name: _tidied(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op6_quality_rules": quality.sql(), "op8_decontaminate": decontaminate.SQL}
