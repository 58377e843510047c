"""Lineage cuts: tables written to the folder that all executors share.

``spark.checkpoint.dir`` names that folder.  It is read from the session; only
where it is unset (tests, local runs) a temporary folder is made and used.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def folder(spark: SparkSession) -> str:
    """The shared folder of this session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        named = "file://" + own
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def _write(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    spark = df.sparkSession
    path = f"{folder(spark).rstrip('/')}/millrace/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path, spark.read.schema(df.schema).parquet(path)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``drop`` leaves it."""
    return _write(df, name)[1]


def keep(df: DataFrame, name: str) -> DataFrame:
    """As ``store``, until ``drop``: a cut of the lineage."""
    path, out = _write(df, name)
    _written.append(path)
    return out


def mark() -> int:
    """How much ``keep`` has written so far, for ``since``."""
    return len(_written)


def since(marked: int) -> list[str]:
    """The paths that ``keep`` wrote after a mark."""
    return _written[marked:]


def tidy(out: DataFrame, marked: int) -> DataFrame:
    """``out``, after deleting what ``keep`` wrote since a mark and ``out`` doesn't read."""
    read = "\n".join(out.inputFiles())
    drop(out.sparkSession, [path for path in since(marked) if f"/{path.rsplit('/', 1)[1]}/" not in read])
    return out


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete kept tables; only for callers whose results are written elsewhere."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
