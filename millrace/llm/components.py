"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import keep


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v); the lowest neighbour becomes the centre."""
    if large:
        sides = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    centres = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("c"))
    centres = keep(centres.select(F.col("u").alias("k"), "c"), "centres")
    joined = sides.join(centres, F.col("u") == F.col("k"))
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("c").alias("v"))
    else:
        out = joined.filter(F.col("v") != F.col("c")).select(F.col("v").alias("u"), F.col("c").alias("v")).union(centres.select(F.col("k").alias("u"), F.col("c").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) for every node but the lowest of its component: v is the lowest.

    Each round writes its edges; a changed count or sum of hashes means that
    another is needed.  Rounds grow with the logarithm of a component.
    """
    edges = keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    sign = None
    while True:
        edges = keep(_stars(_stars(edges, True), False), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == sign:
            return edges
        sign = now
