"""The batch loop with keyed state: content hashes, near hashes and page counts.

Every batch is judged against what earlier batches accepted; candidates whose URL was
accepted or failed in one are left out.  ``snapshot`` is
the loop's own rule: rows of one batch don't see each other, so copies inside a
batch all pass and a page may exceed its cap inside one.  ``strict`` also holds
rows of a batch against each other, in order.  State is written per batch under
its number; a batch that is run again replaces its rows, so a restart neither
loses nor doubles any.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import cascade, dedup
from millrace.sources.shared import written


@dataclass(frozen=True)
class Limits:
    """When the loop stops; 0 is no limit.  Time is tested between batches."""

    target: int = 5000
    batch_size: int = 100
    max_batches: int = 0
    seconds: float = 28800.0


def judge(batch: DataFrame, accepted: DataFrame, known_sha1: DataFrame, t: cascade.Thresholds, remaining: int, mode: str = "snapshot", near: str = "exact") -> DataFrame:
    """One batch with its ``disposition``, by ``ord``.

    batch: ord, source, page_url, image_url, title, has_hull_in_title, sha1,
    dhash, bits, tokens and the descriptors that the cascade names.  accepted:
    page_url, sha1, dhash, bits.  near: ``exact`` compares the stored hashes,
    ``hamming`` the 64 gradient bits.
    """
    pages = accepted.groupBy(F.col("page_url").alias("_page")).agg(F.count(F.lit(1)).alias("_had"))
    keys = accepted.select("sha1").union(known_sha1.select("sha1")).filter("sha1 <> ''").select(F.col("sha1").alias("_sha1")).distinct().withColumn("_k", F.lit(True))
    rows = batch.join(pages, F.col("page_url") == F.col("_page"), "left").join(keys, F.col("sha1") == F.col("_sha1"), "left")
    if near == "hamming":
        pairs = dedup.near_pairs(batch.filter("bits IS NOT NULL"), accepted.filter("bits IS NOT NULL"), "ord", "ord")
        close = pairs.select("l_id").distinct().join(batch.select(F.col("ord").alias("l_id"), F.col("bits").alias("_bits")), "l_id").select("_bits").distinct().withColumn("_n", F.lit(True))
        rows = rows.join(close, F.col("bits") == F.col("_bits"), "left")
    else:
        close = accepted.filter("dhash <> ''").select(F.col("dhash").alias("_dhash")).distinct().withColumn("_n", F.lit(True))
        rows = rows.join(close, F.col("dhash") == F.col("_dhash"), "left")
    rows = rows.withColumn("known_sha1", F.coalesce("_k", F.lit(False))).withColumn("near_known", F.coalesce("_n", F.lit(False)))
    rows = cascade.fast_path(rows, t)
    had = F.coalesce("_had", F.lit(0))
    first = [("per_page_limit", had >= t.per_page), *cascade.descriptor_rules(t)]
    rows = rows.withColumn("disposition", cascade.disposition(first))
    rows = rows.withColumn("_had", had).drop("_page", "_sha1", "_k", "_dhash", "_bits", "_n")
    if mode == "strict":
        return _in_order(rows, t, remaining, near)
    passing = F.col("disposition") == cascade.ACCEPTED
    # the quota comes before the text verdict; a batch is of bounded size, so one window numbers it
    before = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum((passing & F.col("ocr_ok") & _has_size()).cast("int")).over(before), F.lit(0))
    rows = rows.withColumn("_taken", taken)
    late = F.when(passing & (F.col("_taken") >= remaining), "quota_dropped").when(passing & ~F.col("ocr_ok"), "no_digits_or_too_long").when(passing & ~_has_size(), "normalize_failed")
    return rows.withColumn("disposition", late.otherwise(F.col("disposition"))).drop("_had", "_taken")


def _has_size() -> F.Column:
    return F.coalesce((F.col("w") > 0) & (F.col("h") > 0), F.lit(False))


def _in_order(rows: DataFrame, t: cascade.Thresholds, remaining: int, near: str = "exact") -> DataFrame:
    """A batch's passing rows one after the other, each against those before it.

    A row that one rule drops counts for no other, so the rules don't split into
    windows; a batch is of bounded size and one task takes it.
    """
    def fold(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("ord").reset_index(drop=True)
        sha1, dhash, bits, pages, taken, out = set(), set(), [], {}, 0, []

        def close(r) -> bool:
            if near == "hamming":
                return not pd.isna(r.bits) and any((int(r.bits) ^ b).bit_count() <= dedup.NEAR for b in bits)
            return bool(r.dhash) and r.dhash in dhash

        for r in batch.itertuples(index=False):
            verdict = r.disposition
            if verdict == cascade.ACCEPTED:
                page = pages.get(r.page_url, int(batch.at[len(out), "_had"]))
                if page >= t.per_page:
                    verdict = "per_page_limit"
                elif r.sha1 and r.sha1 in sha1:
                    verdict = "duplicate_sha1"
                elif close(r):
                    verdict = "near_duplicate"
                elif taken >= remaining:
                    verdict = "quota_dropped"
                elif not r.ocr_ok:
                    verdict = "no_digits_or_too_long"
                elif not r.sized:
                    verdict = "normalize_failed"
                else:
                    sha1.add(r.sha1)
                    dhash.add(r.dhash)
                    if not pd.isna(r.bits):
                        bits.append(int(r.bits))
                    pages[r.page_url] = page + 1
                    taken += 1
            out.append(verdict)
        return pd.DataFrame({"_ord": batch.ord, "_verdict": out})

    small = rows.select("ord", "disposition", "page_url", "sha1", "dhash", F.col("bits").cast("string").alias("bits"), F.col("_had").cast("long").alias("_had"), "ocr_ok", _has_size().alias("sized"))
    verdicts = small.groupBy().applyInPandas(fold, "_ord long, _verdict string")
    return rows.join(verdicts, F.col("ord") == F.col("_ord")).withColumn("disposition", F.col("_verdict")).drop("_had", "_ord", "_verdict")


def run(spark: SparkSession, candidates: DataFrame, known_sha1: DataFrame, t: cascade.Thresholds = cascade.Thresholds(), limits: Limits = Limits(), mode: str = "snapshot", near: str = "exact", *, state: str) -> DataFrame:
    """All batches' rows with ``batch`` and ``disposition``; resumes from ``state``, the run's own folder.

    candidates are numbered by ``ord`` from 1 in the order they are taken.
    """
    numbered = candidates.withColumn("batch", (F.floor((F.col("ord") - 1) / limits.batch_size) + 1).cast("int"))
    candidates = written(numbered, "candidates", by="batch")  # a batch reads its own folder
    last = candidates.agg(F.max("batch")).first()[0] or 0
    began = time.monotonic()
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = fs.exists(where)
    first = (spark.read.parquet(state).agg(F.max("batch")).first()[0] or 0) + 1 if done else 1
    n = 0
    for number in range(first, last + 1):
        if (limits.max_batches and n >= limits.max_batches) or (limits.seconds and time.monotonic() - began > limits.seconds):
            break
        batch = candidates.filter(F.col("batch") == number).drop("batch")
        if done:
            earlier = spark.read.parquet(state).filter(F.col("batch") < number)
            accepted = earlier.filter(F.col("disposition") == cascade.ACCEPTED)
            # a picture that another source also has isn't tried again
            batch = dedup.pending(batch, accepted, earlier.filter(F.col("disposition").startswith("download_failed")))
        else:
            accepted = batch.filter("false")
        remaining = limits.target - (accepted.count() if done else 0)
        if remaining <= 0:
            break
        out = judge(batch, accepted, known_sha1, t, remaining, mode, near)
        out.write.mode("overwrite").parquet(f"{state}/batch={number}")
        done, n = True, n + 1
    if not done:
        empty = judge(candidates.drop("batch").filter("false"), candidates.filter("false"), known_sha1, t, 0, mode, near)
        return empty.withColumn("batch", F.lit(0))
    return spark.read.parquet(state)
