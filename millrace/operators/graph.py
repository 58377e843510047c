"""Reachability over a link table, level by level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.shared import written


def reach(edges: DataFrame, roots: DataFrame, max_depth: int | None = None, max_found: int | None = None) -> DataFrame:
    """(node, depth) of all nodes that the roots reach, roots at 0.  edges: (src, dst).

    Each level joins the frontier with the edges and leaves out what was seen.
    Levels are written, so a lost executor costs no earlier level.  With
    ``max_found`` no level starts once so many nodes beyond the roots are found;
    the last level may overshoot.
    """
    level = written(roots.select(F.col(roots.columns[0]).alias("node")).distinct(), "frontier")
    seen, depth, found = level.withColumn("depth", F.lit(0)), 0, 0
    while (max_depth is None or depth < max_depth) and (max_found is None or found < max_found):
        depth += 1
        following = level.join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        level = written(following.join(seen.select(F.col("node").alias("_seen")), F.col("node") == F.col("_seen"), "left_anti"), "frontier")
        n = level.count()
        if not n:
            break
        found += n
        seen = seen.unionByName(level.withColumn("depth", F.lit(depth)))
    return seen


def one_hop(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Distinct neighbours of the roots."""
    starts = roots.select(F.col(roots.columns[0]).alias("node"))
    return starts.join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
