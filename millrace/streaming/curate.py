"""The batch loop as a stream: each micro-batch is judged against the accepted table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import batches, cascade


def curate(stream: DataFrame, known_sha1: DataFrame, state: str, checkpoint: str, t: cascade.Thresholds = cascade.Thresholds(), target: int = 5000, mode: str = "strict", near: str = "exact", rows: int = 10_000):
    """Starts the query over what is there now; ``state`` gets a folder a micro-batch.

    A micro-batch that is run again after a failure overwrites its own folder
    and is judged against the earlier ones only, so nothing is accepted twice.
    One of more than ``rows`` rows is judged in parts of about so many, by ``ord``.
    """

    def one(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state)
        there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
        n = -(-batch.count() // rows) or 1
        cuts = batch.approxQuantile("ord", [i / n for i in range(1, n)], 1 / (10 * n)) if n > 1 else []
        edges = [float("-inf"), *sorted(set(cuts)), float("inf")]
        for part, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            some = batch.filter((F.col("ord") > lo) & (F.col("ord") <= hi)) if n > 1 else batch
            earlier = (F.col("batch") < number) | ((F.col("batch") == number) & (F.col("part") < part))
            accepted = spark.read.parquet(state).filter((F.col("disposition") == cascade.ACCEPTED) & earlier) if there or part else batch.filter("false")
            out = batches.judge(some, accepted, known_sha1, t, target - accepted.count(), mode, near)
            out.write.mode("overwrite").parquet(f"{state}/batch={number}/part={part}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
