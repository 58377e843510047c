"""Writers of results.  Tables are the truth; CSV, JSON and Markdown are exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REVIEW_COLUMNS = ("file_name", "source", "page_url", "image_url", "title", "ocr_text", "hull_in_title")


def accepted_row(source: Column, source_id: Column, stem: Column) -> list[Column]:
    """Columns of an accepted row from a candidate with its descriptors."""
    return [
        F.concat(stem, F.lit(".jpg")).alias("file_name"),
        source.alias("source"),
        *(F.col(c) for c in ("page_url", "image_url", "title")),
        F.col("w").alias("orig_width"),
        F.col("h").alias("orig_height"),
        F.round("sharpness", 2).alias("sharpness"),
        F.substring("ocr_text", 1, 100).alias("ocr_text"),
        F.round("ocr_conf", 4).alias("ocr_conf"),
        F.col("sha1"),
        F.col("dhash"),
        F.initcap(F.col("has_hull_in_title").cast("string")).alias("hull_in_title"),
    ]


def append_batch(rows: DataFrame, path: str, batch: int) -> None:
    """A batch's accepted rows.  A batch that is run again replaces itself."""
    rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def export_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def export_review(rows: DataFrame, path: str) -> None:
    export_csv(rows.select(*(F.col(c) for c in REVIEW_COLUMNS)), path)


def export_split(rows: DataFrame, path: str) -> None:
    """Folders split=train and split=test."""
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def class_files(root: str, names: tuple[str, ...] = ("hull_number",)) -> dict[str, str]:
    """The training tool's two small text files, by name."""
    listed = ", ".join(f"'{n}'" for n in names)
    return {"classes.txt": "".join(f"{n}\n" for n in names), "dataset.yaml": f"path: {root}\ntrain: train/images\nval: test/images\nnc: {len(names)}\nnames: [{listed}]\n"}
