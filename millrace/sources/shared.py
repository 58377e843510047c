"""Written tables in the folder that all executors share (``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The shared folder of this session; a temporary one only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        named = "file://" + own
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written once and read back, which cuts its lineage; ``by``: a column with a folder for each value."""
    path = place(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{folder(spark).rstrip('/')}/millrace/{name}-{uuid.uuid4().hex}"


def _system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """One small file, in whatever store the path is."""
    where, system = _system(spark, path)
    out = system.create(where, True)
    out.write(bytearray(data))
    out.close()


def remove(spark: SparkSession, paths: list[str]) -> int:
    """Deletes files or folders; how many there were."""
    return sum(bool(system.delete(where, True)) for where, system in (_system(spark, p) for p in paths))
