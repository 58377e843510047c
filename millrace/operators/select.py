"""Order, caps, quotas, samples and splits.

Positions in a whole table come from ranges with counted sizes, never from one
window over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.sources.shared import written

#: Ranges that a table is dealt over to number its rows.
RANGES = 256


def seeded(key: Column, seed: int) -> Column:
    """A stable pseudo-random order key, the same in other engines."""
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), key.cast("string")).cast("binary"))


def numbered(df: DataFrame, order: list[Column], lead: Column, name: str = "position", hashed: bool = False) -> DataFrame:
    """Adds ``name``: 1 for the first row by ``order``, and so on.

    ``lead`` is the first order key, a hexadecimal hash (``hashed``) or a
    number.  Rows are dealt by ranges of it; the ranges' counts give offsets,
    and each range is numbered by itself.
    """
    if hashed:
        part = F.conv(F.substring(lead, 1, 2), 16, 10).cast("int")
    else:
        df = written(df, "numbered")  # read three times below
        probe = df.select(F.percentile_approx(lead.cast("double"), [i / RANGES for i in range(1, RANGES)], 1000).alias("p")).first()
        cuts = sorted(set(probe.p or []))
        part = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>"), lambda c: c < lead.cast("double"))) if cuts else F.lit(0)
    rows = df.withColumn("_part", part)
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(F.col("_part").alias("_at")).agg(F.count(F.lit(1)).alias("_size"))  # at most RANGES rows
    offsets = sizes.select("_at", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    own = rows.withColumn("_own", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return own.join(F.broadcast(offsets), F.col("_part") == F.col("_at")).withColumn(name, F.col("_own") + F.col("_offset")).drop("_part", "_own", "_at", "_offset")


def priority_key() -> list[Column]:
    """Hull in the metadata first, then the source's rank; add a tie-break."""
    hull = text.metadata_has_hull(F.col("has_hull_in_title"), F.col("image_url"), F.col("page_url"))
    return [F.when(hull, 0).otherwise(1), text.source_rank(F.col("source"))]


def cap(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """At most ``n`` rows of each group, the first by ``order``."""
    rows = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return rows.filter(F.col("_rank") <= n).drop("_rank")


def batch_number(position: Column, size: int) -> Column:
    """1 for the first ``size`` positions, and so on."""
    return (F.floor((position - 1) / size) + 1).cast("long")


def snapshot_keys(df: DataFrame, key: str, batch: str, ok: Column) -> DataFrame:
    """Adds ``accepted``: keys are accepted in the first batch where a row passes,
    with all passing rows of that batch; an empty key is always accepted."""
    first = df.groupBy(F.col(key).alias("_key")).agg(F.min(F.when(ok, F.col(batch))).alias("_first"))
    rows = df.join(first, F.col(key).eqNullSafe(F.col("_key")))
    free = F.coalesce(F.col(key), F.lit("")) == ""
    return rows.withColumn("accepted", ok & (free | (F.col(batch) == F.col("_first")))).drop("_key", "_first")


def snapshot_cap(df: DataFrame, group: str, batch: str, ok: Column, n: int) -> DataFrame:
    """Adds ``accepted``: a group takes rows while earlier batches gave it fewer than ``n``."""
    sizes = df.groupBy(F.col(group).alias("_group"), F.col(batch).alias("_batch")).agg(F.sum(F.when(ok, 1).otherwise(0)).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_batch").rowsBetween(Window.unboundedPreceding, -1)
    # rows of a batch that reached the cap count no more: only batches accepted before matter
    sizes = sizes.select("_group", "_batch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = df.join(sizes, (F.col(group) == F.col("_group")) & (F.col(batch) == F.col("_batch")))
    return rows.withColumn("accepted", ok & (F.col("_before") < n)).drop("_group", "_batch", "_before")


def quota(df: DataFrame, ok: Column, order: list[Column], lead: Column, remaining: int) -> DataFrame:
    """Adds ``taken``: the first ``remaining`` passing rows by ``order``."""
    place = numbered(df.filter(ok), order, lead, "_place")
    out = place.withColumn("taken", F.col("_place") <= remaining).drop("_place")
    return out.unionByName(df.filter(~F.coalesce(ok, F.lit(False))).withColumn("taken", F.lit(False)))


def sample(df: DataFrame, key: Column, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows, or all of fewer, by a seeded order."""
    return df.orderBy(seeded(key, seed), key).limit(n)


def split(df: DataFrame, key: Column, share: float = 0.85, seed: int = 42) -> DataFrame:
    """Adds ``split``: exactly the share's whole part in train, at least one; a single row is train."""
    n = df.count()
    cut = max(1, int(n * share)) if n > 1 else n
    order = seeded(key, seed)
    rows = numbered(df, [order, key], order, "_place", hashed=True)
    return rows.withColumn("split", F.when(F.col("_place") <= cut, "train").otherwise("test")).drop("_place")


def since_review(df: DataFrame, position: Column, reviewed: int, n: int = 30, seed: int = 42, key: Column | None = None) -> DataFrame:
    """A sample of the rows after the last reviewed position."""
    return sample(df.filter(position > reviewed), key if key is not None else position, n, seed)
