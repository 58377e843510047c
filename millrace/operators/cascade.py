"""The filter cascade: every candidate gets exactly one disposition."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import images, text

ACCEPTED = "accepted"


@dataclass(frozen=True)
class Thresholds:
    """What a picture must have."""

    per_page: int = 3
    min_bytes: int = 10 * 1024
    max_bytes: int = 25 * 1024 * 1024
    min_width: int = 500
    min_height: int = 350
    min_sharpness: float = 60.0
    min_digits: int = 1
    max_chars: int = 15


def disposition(rules: list[tuple[str | Column, Column]]) -> Column:
    """The first rule, in order, that a row breaks.  A null test is not broken."""
    out = None
    for name, broken in rules:
        value = F.lit(name) if isinstance(name, str) else name
        test = F.coalesce(broken, F.lit(False))
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(ACCEPTED) if out is not None else F.lit(ACCEPTED)


def descriptor_rules(t: Thresholds = Thresholds()) -> list[tuple[str | Column, Column]]:
    """The rules over landed descriptors that need no state, in their order."""
    failed = F.coalesce(F.col("error_type"), F.lit("")) != ""
    too_large = F.col("n_bytes") > t.max_bytes
    content = F.lower(F.coalesce(F.col("content_type"), F.lit("")))
    return [
        ("non_image_content_type", ~failed & (content != "") & ~content.startswith("image/")),
        (F.concat(F.lit("download_failed_"), F.when(failed, F.col("error_type")).otherwise("ValueError")), failed | too_large),
        ("too_small_file", F.col("n_bytes") < t.min_bytes),
        ("invalid_format", ~images.is_allowed_format(F.col("img_type"))),
        ("duplicate_sha1", F.col("known_sha1")),
        ("corrupt_image", F.col("w").isNull() | F.col("h").isNull()),
        ("too_small_dims", (F.col("w") < t.min_width) | (F.col("h") < t.min_height)),
        ("blurry", F.coalesce(F.col("sharpness"), F.lit(0.0)) < t.min_sharpness),
        ("near_duplicate", F.col("near_known")),
    ]


def fast_path(df: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Adds ocr_ok, ocr_text and ocr_conf: the fixed answer for rows whose metadata
    name a hull number, else the cleaned ``tokens``."""
    hull = text.metadata_has_hull(F.col("has_hull_in_title"), F.col("image_url"), F.col("page_url"))
    body, conf = text.fold_tokens(F.col("tokens"))
    rows = df.withColumn("fast_path", hull).withColumn("_ocr", text.strip_watermarks(body))
    return rows.select(
        *(c for c in rows.columns if c != "_ocr"),
        F.when(hull, True).otherwise(F.coalesce(text.ocr_accepts(F.col("_ocr"), t.min_digits, t.max_chars), F.lit(False))).alias("ocr_ok"),
        F.when(hull, "[metadata_hull_match]").otherwise(F.coalesce("_ocr", F.lit(""))).alias("ocr_text"),
        F.when(hull, 1.0).otherwise(F.coalesce(conf, F.lit(0.0))).alias("ocr_conf"),
    )


def reason_counts(df: DataFrame, column: str = "disposition") -> DataFrame:
    return df.groupBy(F.col(column).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def failure_rollup(df: DataFrame, column: str = "disposition") -> DataFrame:
    """Counts by reason and, for failed downloads, by error type; a null type is the reason's total."""
    prefix = "download_failed_"
    failed = F.col(column).startswith(prefix)
    rows = df.select(F.when(failed, "download_failed").otherwise(F.col(column)).alias("reason"), F.when(failed, F.substring(column, len(prefix) + 1, 1000)).otherwise("").alias("error_type"))
    return rows.rollup("reason", "error_type").agg(F.count(F.lit(1)).alias("n")).filter("reason IS NOT NULL AND (error_type IS NULL OR error_type <> '')")
