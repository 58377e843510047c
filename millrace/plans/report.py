"""The run report: one row of counters and rates, and its Markdown form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rate_per_hour(count: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, F.round(count / (seconds / 3600), 1)).otherwise(0.0)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100, 1)).otherwise(0.0)


def top(counts: DataFrame, k: int, name: str = "reason", count: str = "n") -> DataFrame:
    """The k largest counts; equal ones by name."""
    return counts.orderBy(F.desc(count), name).limit(k)


def report(judged: DataFrame, target: int, seconds: float, top_reasons: int = 5) -> DataFrame:
    """One row over judged candidates (disposition, fast_path, ocr_ok)."""
    reached = F.col("disposition").isin("accepted", "no_digits_or_too_long", "normalize_failed", "quota_dropped")
    counts = judged.groupBy("disposition").agg(  # a row for each reason
        F.count(F.lit(1)).alias("n"),
        F.count_if(reached & F.col("ocr_ok")).alias("passed"),
        F.count_if(reached & ~F.col("ocr_ok")).alias("failed"),
        F.count_if(reached & F.col("fast_path")).alias("fast"),
    )
    sums = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_candidates"),
        F.coalesce(F.sum(F.when(F.col("disposition") == "accepted", F.col("n"))), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum("passed"), F.lit(0)).alias("ocr_passed"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("ocr_failed"),
        F.coalesce(F.sum("fast"), F.lit(0)).alias("metadata_fast_path"),
        F.sort_array(F.collect_list(F.when(F.col("disposition") != "accepted", F.struct((-F.col("n")).alias("n"), F.col("disposition").alias("reason"))))).alias("_r"),
    )
    listed = F.transform(F.slice("_r", 1, top_reasons), lambda x: F.struct(x["reason"].alias("reason"), (-x["n"]).alias("n")))
    return sums.withColumn("rejection_top", listed).drop("_r").select(
        "*",
        F.lit(target).alias("target"),
        (F.lit(target) - F.col("accepted")).alias("remaining_to_target"),
        F.round(F.lit(float(seconds)), 1).alias("duration_sec"),
        rate_per_hour(F.col("accepted"), F.lit(float(seconds))).alias("accepted_per_hour"),
        percent(F.col("metadata_fast_path"), F.col("ocr_passed")).alias("metadata_pct"),
    )


def stamp(at: Column) -> Column:
    """A time as the state and the report write it."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")


def state(judged: DataFrame, at: Column) -> DataFrame:
    """The state export, one row: what was accepted (at most the target), counts by reason and page, failed URLs.

    judged: disposition, sha1, dhash, page_url, image_url, fast_path, ocr_ok.
    """
    ok, failed = F.col("disposition") == "accepted", F.col("disposition").startswith("download_failed")
    key = lambda c: F.sort_array(F.collect_set(F.when(ok & (F.col(c) != ""), F.col(c)))).alias(f"accepted_{c}")
    one = judged.agg(
        F.count_if(ok).alias("accepted_count"),
        key("sha1"),
        key("dhash"),
        F.create_map(F.lit("passed"), F.count_if(ok & F.col("ocr_ok")), F.lit("fast_path"), F.count_if(ok & F.col("fast_path"))).alias("ocr_stats"),
        F.sort_array(F.collect_set(F.when(failed, F.col("image_url")))).alias("failed_urls"),
    )
    pairs = lambda df, c: df.groupBy(F.col(c).alias("k")).agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "n")))).alias("m"))
    reasons = pairs(judged.filter(~ok), "disposition").withColumnRenamed("m", "rejection_counts")
    pages = pairs(judged.filter(ok & (F.col("page_url") != "")), "page_url").withColumnRenamed("m", "accepted_page_counts")
    out = one.withColumn("_one", F.lit(1))
    for more in (reasons, pages):  # a row each
        out = out.join(more.withColumn("_k", F.lit(1)), F.col("_one") == F.col("_k")).drop("_k")
    return out.drop("_one").withColumn("last_save", stamp(at))


def markdown(row, at: str = "") -> str:
    """The report's row as Markdown; ``at``: its time stamp."""
    lines = ["# Run report", *(["", f"Made at {at}"] if at else []), "", "| measure | value |", "|---|---|"]
    lines += [f"| {k} | {v} |" for k, v in row.asDict().items() if k != "rejection_top"]
    lines += ["", "| rejected for | rows |", "|---|---|", *(f"| {r.reason} | {r.n} |" for r in row.rejection_top)]
    return "\n".join(lines) + "\n"


def probe_summary(probes: DataFrame, group: str) -> DataFrame:
    """Per group: probes that are OK or not, shortest, longest and mean time of the good ones."""
    ok = F.col("status").contains("200") | (F.col("status") == "OK")
    return probes.groupBy(group).agg(
        F.count_if(ok).alias("n_ok"),
        F.count_if(~ok).alias("n_failed"),
        F.min(F.when(ok, F.col("elapsed"))).alias("min_elapsed"),
        F.max(F.when(ok, F.col("elapsed"))).alias("max_elapsed"),
        F.round(F.avg(F.when(ok, F.col("elapsed"))), 4).alias("avg_elapsed"),
    )


def advice(direct_a: Column, direct_b: Column, proxied: Column) -> Column:
    """What to run, from the numbers of good probes."""
    return F.when((direct_a >= 1) & (direct_b >= 1), "direct").when(proxied >= 1, "proxy").otherwise("check_network")
