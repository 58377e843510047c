"""Readers of landed files.  Missing keys are empty strings, as the data model has it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import images, text, urls

ACCEPTED = T.StructType(
    [T.StructField(n, T.StringType()) for n in "file_name source page_url image_url title orig_width orig_height sharpness ocr_text ocr_conf sha1 dhash hull_in_title".split()]
)
CANDIDATES = T.StructType([T.StructField(n, T.StringType()) for n in "source image_url page_url title has_hull_in_title".split()])
STATE = "accepted_count bigint, accepted_sha1 array<string>, accepted_dhash array<string>, rejection_counts map<string,bigint>, ocr_stats map<string,bigint>, accepted_page_counts map<string,bigint>, failed_urls array<string>, last_save string"
#: File names of accepted tables, and the folders that hold earlier pictures.
ACCEPTED_NAMES = ("accepted.csv", "accepted_china.csv")
PICTURE_FOLDERS = ("processed", "train/images", "test/images", "labeling/seed/images", "labeling/hard/images")


def _csv(spark: SparkSession, path: str | list[str], schema: T.StructType, **options) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("enforceSchema", False)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def _present(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def accepted(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Accepted rows, typed; a byte order mark before the header is no part of it."""
    rows = _csv(spark, path, ACCEPTED)
    number = lambda c, t: F.col(c).try_cast(t).alias(c)
    typed = {"orig_width": "int", "orig_height": "int", "sharpness": "double", "ocr_conf": "double"}
    return rows.select(*(number(c, typed[c]) if c in typed else (F.col(c) == "True").alias(c) if c == "hull_in_title" else text.key(F.col(c)).alias(c) for c in rows.columns))


_SCHEME = r"^[A-Za-z0-9+.\-]+:(//[^/]*)?"


def _bare(path: str) -> str:
    """A path without scheme and host, which listings write in several ways, and without a slash at its end."""
    return re.sub(_SCHEME, "", path).rstrip("/")


def _below(path: Column, folder: str) -> Column:
    return F.regexp_replace(path, _SCHEME, "").startswith(_bare(folder) + "/")


def history(spark: SparkSession, root: str, exclude: str | None = None) -> DataFrame:
    """Keys of all accepted tables below ``root`` but those below ``exclude``."""
    rows = spark.read.schema(ACCEPTED).option("header", True).option("multiLine", True).option("escape", '"').option("recursiveFileLookup", True).option("pathGlobFilter", "accepted*.csv").csv(root)
    file = F.col("_metadata.file_path")
    rows = rows.filter(F.element_at(F.split(file, "/"), -1).isin(*ACCEPTED_NAMES))
    if exclude:
        rows = rows.filter(~_below(file, exclude))
    return history_keys(rows)


def history_keys(rows: DataFrame) -> DataFrame:
    """image_url, canonical_url, page_url and sha1 of earlier rows; empty where there is none."""
    image = text.key(F.col("image_url"))
    return rows.select(image.alias("image_url"), F.when(image == "", "").otherwise(urls.canonical(image)).alias("canonical_url"), text.key(F.col("page_url")).alias("page_url"), text.key(F.col("sha1")).alias("sha1"))


def picture_hashes(spark: SparkSession, root: str, exclude: str | None = None) -> DataFrame:
    """SHA-1 of the jpg and png files in the known folders one level below ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{jpg,png}").load(root)
    pattern = "^" + re.escape(_bare(root)) + "/[^/]+/(?:" + "|".join(PICTURE_FOLDERS) + ")/[^/]+$"
    files = files.filter(F.regexp_replace("path", _SCHEME, "").rlike(pattern))
    if exclude:
        files = files.filter(~_below(F.col("path"), exclude))
    return files.select("path", images.file_sha1(F.col("content")).alias("sha1"))


def candidates(spark: SparkSession, path: str) -> DataFrame | None:
    """Cached candidates with their source ids, or None where there is no file."""
    if not _present(spark, path):
        return None
    rows = _csv(spark, path, CANDIDATES)
    return rows.select(
        *(text.key(F.col(c)).alias(c) for c in ("source", "page_url", "image_url")),
        urls.source_id(text.key(F.col("image_url"))).alias("source_id"),
        text.key(F.col("title")).alias("title"),
        F.coalesce(F.col("has_hull_in_title") == "True", F.lit(False)).alias("has_hull_in_title"),
    )


def state(spark: SparkSession, path: str) -> DataFrame:
    """One row a snapshot; a half-written file gives no row."""
    rows = spark.read.schema(STATE).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return rows.filter("accepted_count IS NOT NULL")


def state_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots as they land in a folder, one JSON object a line, with their time; a half-written line gives no row."""
    rows = spark.readStream.schema("ts timestamp, accepted_count bigint, rejection_counts map<string,bigint>").json(folder)
    return rows.filter("ts IS NOT NULL AND accepted_count IS NOT NULL")
