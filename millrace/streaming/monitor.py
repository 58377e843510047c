"""Progress alerts over polled snapshots, as a batch and as a stream.

A snapshot has a time, the accepted count and the rejection counts.  Per run:
the change since the last snapshot; a low-yield streak that rises with a small
gain, falls by one otherwise and alerts, and resets, at two; a stall when
nothing was gained for a while, told once until progress re-arms it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.sources import readers

LOW, STREAK, STALL_SECONDS = 5, 2, 300.0
_OUT = "run string, ts timestamp, accepted_count bigint, new_count bigint, elapsed double, streak int, low_yield_alert boolean, stall_alert boolean"


def deltas(df: DataFrame, run: str, ts: str, count: str) -> DataFrame:
    """Adds new_count and elapsed seconds since the run's last snapshot."""
    w = Window.partitionBy(run).orderBy(ts)
    seconds = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    return df.withColumn("new_count", F.col(count) - F.lag(count).over(w)).withColumn("elapsed", seconds - F.lag(seconds).over(w))


def streak_step(state: Column, gain: Column, low: int = LOW, alert_at: int = STREAK) -> Column:
    """One step of the recurrence over a struct of streak and alert."""
    grown = F.when((gain > 0) & (gain < low), state["streak"] + 1).otherwise(F.greatest(F.lit(0), state["streak"] - 1))
    hit = (gain > 0) & (gain < low) & (grown >= alert_at)
    return F.struct(F.when(hit, 0).otherwise(grown).cast("int").alias("streak"), hit.alias("alert"), (state["n"] + hit.cast("int")).cast("int").alias("n"))


def low_yield_alerts(df: DataFrame, run: str, ts: str, gain: str) -> DataFrame:
    """(run, alerts, streak) after all of a run's gains in order: a fold, for no window frame holds it."""
    start = F.struct(F.lit(0).alias("streak"), F.lit(False).alias("alert"), F.lit(0).alias("n"))
    rows = df.filter(F.col(gain).isNotNull()).groupBy(run).agg(F.sort_array(F.collect_list(F.struct(F.col(ts), F.col(gain).alias("g")))).alias("all"))
    end = F.aggregate("all", start, lambda s, x: streak_step(s, x["g"]))
    return rows.select(run, end["n"].cast("long").alias("alerts"), end["streak"].cast("long").alias("streak"))


def stalls(df: DataFrame, run: str, ts: str, gain: str, seconds: float = STALL_SECONDS) -> DataFrame:
    """Adds idle seconds since the last gain, and ``stall``: the first snapshot of an idle stretch beyond the limit."""
    w = Window.partitionBy(run).orderBy(ts)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    now = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    rows = df.withColumn("_since", F.max(F.when((F.col(gain) > 0) | F.col(gain).isNull(), now)).over(upto))
    rows = rows.withColumn("idle", now - F.coalesce("_since", now))
    over = F.col("idle") > seconds
    rows = rows.withColumn("stall", over & ~F.coalesce(F.lag(over).over(w), F.lit(False)))
    return rows.drop("_since")


def diagnosis(counts: Column) -> Column:
    """From a map of rejection counts: whether failed downloads are over twice all others."""
    failed = F.coalesce(F.element_at(counts, "download_failed"), F.lit(0))
    rest = F.aggregate(F.map_values(F.map_filter(counts, lambda k, _: ~k.startswith("download_failed"))), F.lit(0).cast("long"), lambda a, x: a + x)
    return F.struct(failed.alias("download_failed"), rest.alias("other"), F.when(failed > rest * 2, "downloads").otherwise("candidates").alias("cause"))


def _follow(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """State: last time, last count, streak, time of the last gain, stall told."""
    have = list(state.get) if state.exists else None
    for frame in frames:
        out = []
        for ts, count in frame.sort_values("ts")[["ts", "accepted_count"]].itertuples(index=False):
            now = ts.timestamp()
            if have is None:
                have = [now, int(count), 0, now, False]
                out.append((key[0], ts, int(count), None, None, 0, False, False))
                continue
            gain, elapsed = int(count) - have[1], now - have[0]
            low = 0 < gain < LOW
            streak = have[2] + 1 if low else max(0, have[2] - 1)
            alert = low and streak >= STREAK
            moved = now if gain > 0 else have[3]
            stall = gain <= 0 and now - moved > STALL_SECONDS and not have[4]
            have = [now, int(count), 0 if alert else streak, moved, False if gain > 0 else have[4] or stall]
            out.append((key[0], ts, int(count), gain, elapsed, have[2], alert, stall))
        yield pd.DataFrame(out, columns=["run", "ts", "accepted_count", "new_count", "elapsed", "streak", "low_yield_alert", "stall_alert"]).astype({"new_count": "Int64"})
    if have is not None:
        state.update(tuple(have))


def follow(snapshots: DataFrame) -> DataFrame:
    """A stream of (run, ts, accepted_count) with its alerts, state kept per run."""
    return snapshots.groupBy("run").applyInPandasWithState(_follow, _OUT, "last double, count bigint, streak int, moved double, told boolean", "append", "NoTimeout")


def alerts(followed: DataFrame) -> DataFrame:
    """(run, ts, alert): a row for each alert of a snapshot."""
    told = F.array_compact(F.array(F.when(F.col("low_yield_alert"), "low_yield"), F.when(F.col("stall_alert"), "stall")))
    return followed.select("run", "ts", F.explode(told).alias("alert"))


def watch(spark: SparkSession, folder: str, out: str, checkpoint: str, run: str = "run"):
    """Follows the snapshots that are in a folder: rows go to ``out``, a folder a micro-batch, alerts to the console."""

    def one(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        for r in alerts(spark.read.parquet(f"{out}/batch={number}")).orderBy("ts").collect():  # alerts are few: each resets its streak
            print(f"{r.ts} {r.run}: {r.alert}")

    found = follow(readers.state_stream(spark, folder).withColumn("run", F.lit(run)))
    return found.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
