"""A whole run: history, candidates, order, batches, review, split and report.

The landed pictures are a table ``image_url, content, content_type, error_type,
tokens``: bytes, or the error that the download ended with, and the text tokens
read from the picture.
"""

from __future__ import annotations

import functools
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import images, text, urls
from millrace.operators import batches, cascade, dedup, extract, select
from millrace.plans import report as reports
from millrace.sources import readers, writers
from millrace.sources.shared import written


@dataclass(frozen=True)
class Config:
    """What changes a run's results; paths have no defaults."""

    output: str
    limits: batches.Limits = field(default_factory=batches.Limits)
    thresholds: cascade.Thresholds = field(default_factory=cascade.Thresholds)
    sources: tuple[str, ...] = ("bing", "usni", "navsource", "maritimequest", "wikimedia")
    max_per_source: int = 10_000
    seed: int = 42
    train_share: float = 0.85
    review_rows: int = 30
    mode: str = "strict"
    near: str = "exact"
    page_rule: bool = True


def discover(spark: SparkSession, searches: dict[str, tuple[DataFrame, str | None]], directories: dict[str, tuple[DataFrame, DataFrame]], api: tuple[DataFrame, DataFrame] | None = None, cache: DataFrame | None = None, per_source: int = 10_000) -> DataFrame:
    """Candidates of landed answers, after those that the cache has.

    searches: by source, answer pages (html) and the domain that results must have,
    or None; directories: by site, landed pages (url, html) and the roots of its crawl
    (url); api: answers (body) of the title search and of the picture lookup.
    """
    columns = ["source", "page_url", "image_url", "source_id", "title", "has_hull_in_title", "ord"]
    found = [extract.search_candidates(extract.search_results(pages), source, domain) for source, (pages, domain) in searches.items()]
    found += [extract.crawl(pages, roots, site) for site, (pages, roots) in directories.items()]
    if api:
        rows = extract.lookup(extract.api_titles(api[0]), extract.api_pictures(api[1]))
        title, image = text.clean_title(F.col("title")), F.col("image_url")
        found.append(rows.select(F.lit("wikimedia").alias("source"), F.lit("").alias("page_url"), image, urls.source_id(image).alias("source_id"), title.alias("title"), (text.title_has_hull(title) | text.has_strict_hull(image)).alias("has_hull_in_title"), "ord"))
    every = functools.reduce(DataFrame.unionByName, [f.select(*columns) for f in found])
    some = select.cap(every, ["source"], [F.col("ord"), F.col("page_url"), F.col("image_url")], per_source)
    none = spark.createDataFrame([], some.schema)
    return dedup.merge_new(none if cache is None else cache, some, ["ord", "page_url"]).drop("ord")


def describe(landed: DataFrame) -> DataFrame:
    """Descriptors of landed pictures, a row a URL: the first by its bytes' hash of several."""
    content = F.col("content")
    rows = landed.select(
        F.col("image_url").alias("_url"),
        "content_type",
        F.coalesce("error_type", F.lit("")).alias("error_type"),
        F.octet_length(content).cast("long").alias("n_bytes"),
        images.sniff(content).alias("img_type"),
        F.coalesce(images.file_sha1(content), F.lit("")).alias("sha1"),
        images.descriptors(content).alias("d"),
        "tokens",
    )
    rows = rows.select("*", F.col("d.w").alias("w"), F.col("d.h").alias("h"), F.col("d.sharpness").alias("sharpness"), F.when(F.col("d.bits") != "", images.bits_to_long(F.col("d.bits"))).alias("bits"), F.when(F.col("d.bits") != "", images.hash_of_bits(F.col("d.bits"))).otherwise("").alias("dhash")).drop("d")
    return dedup.first_seen(rows, ["_url"], ["sha1"])


def ordered(candidates: DataFrame, config: Config) -> DataFrame:
    """Candidates of the wanted sources with ``ord``: hull first, source rank, a seeded order."""
    wanted = candidates.filter(F.col("source").isin(*config.sources))
    key = F.concat_ws("|", "source", "source_id")
    mixed = select.seeded(key, config.seed)
    some = select.cap(wanted, ["source"], [mixed, key], config.max_per_source)
    once = dedup.first_seen(some, ["source", "source_id"], ["page_url", "title"])
    hull, rank = select.priority_key()
    # sixty bits of the order: flag, rank, and the head of the seeded hash
    lead = (hull * 10 + rank) * F.lit(float(1 << 40)) + F.conv(F.substring(mixed, 1, 10), 16, 10).cast("double")
    return select.numbered(written(once, "chosen"), [hull, rank, mixed, key], lead, "ord")


def run(spark: SparkSession, candidates: DataFrame, landed: DataFrame, history: DataFrame, config: Config) -> DataFrame:
    """Judges what history, earlier runs and the state don't know; returns the report's row.

    candidates: source, page_url, image_url, source_id, title, has_hull_in_title.
    history: the keys of ``readers.history_keys``.
    """
    began = time.monotonic()
    fresh = dedup.against_history(candidates, history, config.page_rule)
    chosen = written(ordered(fresh, config), "ordered")
    wanted = landed.join(chosen.select(F.col("image_url").alias("_wanted")).distinct(), F.col("image_url") == F.col("_wanted"), "left_semi")  # only these are decoded
    rows = chosen.join(describe(wanted), F.col("image_url") == F.col("_url"), "left").drop("_url")
    rows = rows.withColumn("error_type", F.coalesce("error_type", F.lit("NotLanded"))).withColumn("sha1", F.coalesce("sha1", F.lit(""))).withColumn("dhash", F.coalesce("dhash", F.lit("")))
    judged = batches.run(spark, rows, history.select("sha1"), config.thresholds, config.limits, config.mode, config.near, state=f"{config.output}/state")
    accepted = judged.filter(F.col("disposition") == cascade.ACCEPTED)
    stem = text.file_stem(F.col("source"), F.col("source_id"), F.col("title"))
    table = accepted.select("ord", *writers.accepted_row(F.col("source"), F.col("source_id"), stem))
    writers.export_csv(table.drop("ord"), f"{config.output}/accepted")
    writers.export_csv(fresh.select(*readers.CANDIDATES.fieldNames()), f"{config.output}/candidates")
    writers.export_review(select.sample(table, F.col("file_name"), config.review_rows, config.seed), f"{config.output}/review")
    writers.export_split(select.split(table.drop("ord"), F.col("file_name"), config.train_share, config.seed), f"{config.output}/split")
    out = written(reports.report(judged, config.limits.target, time.monotonic() - began), "report")
    writers.export_json(out, f"{config.output}/report")
    return out
