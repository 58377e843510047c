"""python -m millrace: one run over landed tables.  Prints the report as Markdown."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from millrace.operators.batches import Limits
from millrace.operators.cascade import Thresholds
from millrace.plans import lifecycle, report
from millrace.sources import readers


def arguments() -> argparse.ArgumentParser:
    c, t, n = lifecycle.Config(""), Thresholds(), Limits()
    p = argparse.ArgumentParser(prog="millrace")
    p.add_argument("--candidates", required=True, help="CSV of candidates")
    p.add_argument("--landed", required=True, help="parquet of landed pictures")
    p.add_argument("--output", required=True)
    p.add_argument("--history", help="folder with accepted CSV files of earlier runs")
    p.add_argument("--sources", default=",".join(c.sources))
    p.add_argument("--max-per-source", type=int, default=c.max_per_source)
    p.add_argument("--target", type=int, default=n.target)
    p.add_argument("--batch-size", type=int, default=n.batch_size)
    p.add_argument("--max-batches", type=int, default=n.max_batches, help="0: no limit")
    p.add_argument("--time-limit", type=float, default=n.seconds, help="seconds, tested between batches; 0: no limit")
    p.add_argument("--min-width", type=int, default=t.min_width)
    p.add_argument("--min-height", type=int, default=t.min_height)
    p.add_argument("--sharpness", type=float, default=t.min_sharpness)
    p.add_argument("--min-bytes", type=int, default=t.min_bytes)
    p.add_argument("--min-digits", type=int, default=t.min_digits)
    p.add_argument("--max-chars", type=int, default=t.max_chars)
    p.add_argument("--per-page", type=int, default=t.per_page)
    p.add_argument("--seed", type=int, default=c.seed)
    p.add_argument("--mode", choices=("strict", "snapshot"), default=c.mode)
    p.add_argument("--near", choices=("exact", "hamming"), default=c.near)
    p.add_argument("--no-page-rule", action="store_true", help="history excludes pictures, not whole pages")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    a = arguments().parse_args(argv)
    spark = spark or SparkSession.builder.appName("millrace").getOrCreate()
    found = readers.candidates(spark, a.candidates)
    if found is None:
        raise SystemExit(f"no candidates at {a.candidates}")
    known = readers.history(spark, a.history, exclude=a.output) if a.history else spark.createDataFrame([], "image_url string, canonical_url string, page_url string, sha1 string")
    config = lifecycle.Config(
        output=a.output,
        limits=Limits(a.target, a.batch_size, a.max_batches, a.time_limit),
        thresholds=Thresholds(a.per_page, a.min_bytes, Thresholds().max_bytes, a.min_width, a.min_height, a.sharpness, a.min_digits, a.max_chars),
        sources=tuple(s for s in a.sources.split(",") if s),
        max_per_source=a.max_per_source,
        seed=a.seed,
        mode=a.mode,
        near=a.near,
        page_rule=not a.no_page_rule,
    )
    text = report.markdown(lifecycle.run(spark, found, spark.read.parquet(a.landed), known, config).first())
    print(text)
    return text


if __name__ == "__main__":
    main()
