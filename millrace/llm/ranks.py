"""Ranks within classes of any size, without gathering a class in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A class is dealt over so many parts, which are counted first.
PARTS = 256


def salted(df: DataFrame) -> DataFrame:
    """``df`` with ``_salt``, by which rows that are equal otherwise are told apart.

    To be written before it is ranked: only in a written table is it the same
    each time it is read.
    """
    return df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)).cast("int"))


def ranked(df: DataFrame, cls: str, ids: list[str], rank: str) -> DataFrame:
    """``df`` with ``rank``, 0 upwards without gaps among rows of equal ``cls``.

    Rows are dealt by a hash of ``ids``; the parts' sizes, summed in order,
    give each part its offset, and only a part is ever sorted as a whole.  Rows
    that may be repeated need a ``salted`` table and its column among ``ids``.
    """
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(*ids), F.lit(PARTS)).cast("int"))
    sizes = dealt.groupBy(cls, "_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(cls).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(cls).alias("_cls"), F.col("_part").alias("_at"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    own = F.row_number().over(Window.partitionBy(cls, "_part").orderBy(*ids)) - 1
    joined = dealt.withColumn("_own", own).join(offsets, (F.col(cls) == F.col("_cls")) & (F.col("_part") == F.col("_at")))
    return joined.withColumn(rank, F.col("_offset") + F.col("_own")).drop("_part", "_own", "_cls", "_at", "_offset")


def coarse(size: Column, bits: int) -> Column:
    """``size`` rounded up to so many leading bits: few distinct values, however many sizes."""
    shift = F.greatest(F.lit(0), F.length(F.bin(size)) - bits)
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    return F.call_function("shiftleft", F.call_function("shiftright", size + unit - 1, shift), shift)
