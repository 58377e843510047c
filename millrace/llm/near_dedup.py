"""Near-duplicates by DartMinHash over weighted word shingles.

A document is the multiset of its 5-word shingles; a shingle's weight is its
count.  Every unit of weight of a shingle owns a strip of the half-plane, on
which darts fall as a Poisson process whose arrivals come from hashes of strip
and number.  So two documents see the same darts on the weight that they share.
A dart names one of the coordinates; each keeps its earliest dart.  Strips are
read up to a rank that yields a few darts a coordinate, so most strips cost one
hash; documents with an empty coordinate are read on to twice the rank.  Two
documents agree in a coordinate with a probability of their weighted Jaccard
similarity.

Bands of coordinates put texts into buckets; exact similarities decide.  Texts are
one node for all their copies, named by a digest.  Any two texts of a bucket that are
similar enough end in one class, and no bucket's pairs are listed:

1. Each text of a bucket is held against the bucket's lowest; links become
   components by alternating stars.
2. Texts of buckets that have several components yet are joined by prefixes: with
   their shingles by rising frequency among them, two texts of similarity t share one
   of the first n - ceil(2t / (1 + t) n) + 1 of the shorter and of the first
   n - ceil(t n) + 1 of the longer.  Boilerplate is frequent, so texts that share no
   more meet nowhere.  First the texts of a shingle are held against the one with the
   fewest words of its own, then what is left of pairs of two components is, if
   lengths and places leave room for the overlap needed.

A link is missed where no band agrees: at similarity 0.8, once in 13,000 pairs.

Words are runs of letters and digits, A-Z folded.  A text of fewer than five
words, but not none, is one shingle.  Defined cases: a null text equals the
empty one, and texts without words are classed with equal texts only; rows of equal
ids and different texts are classed each by its text; the lowest id of its rows names
a class, so ties don't matter; a class whose rows all lack an id is named null; an
empty table gives an empty one; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.scratch import keep
from millrace.llm.words import ALNUM, lex, mix, parts, shingles

WORDS = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 5
#: Darts a coordinate beyond log(coordinates), on average.
SPARE = 3.0


def strips(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every unit of weight, sorted by both."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    if not len(row):
        return row, h
    fresh = np.ones(len(row), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(fresh)
    unit = np.arange(len(row)) - np.repeat(at, np.diff(np.append(at, len(row))))
    return row, np.where(unit == 0, h, mix(h + unit.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))


def _arrival(key: np.ndarray) -> np.ndarray:
    """An exponential gap from a hash."""
    return -np.log(((key >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)


def signatures(row: np.ndarray, strip: np.ndarray, rows: int, coordinates: int) -> np.ndarray:
    """rows x coordinates of the earliest darts' names; 0 where a row has no strip."""
    out = np.zeros((rows, coordinates), np.uint64)
    weight = np.bincount(row, minlength=rows)
    todo = np.flatnonzero(weight)
    reach = np.zeros(rows)
    reach[todo] = coordinates * (math.log(coordinates) + SPARE) / weight[todo]
    while len(todo):
        chosen = np.zeros(rows, bool)
        chosen[todo] = True
        own = chosen[row]
        r, key = row[own], strip[own]
        rank = np.zeros(len(r))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        turn = 0
        while len(r):
            turn += 1
            name = mix(key + np.uint64(turn * 0x9FB21C651E98DF25 & 0xFFFFFFFFFFFFFFFF))
            rank = rank + _arrival(name)
            near = rank <= reach[r]
            r, key, rank = r[near], key[near], rank[near]
            found.append((r, rank, mix(name[near] ^ np.uint64(0xC2B2AE3D27D4EB4F))))
        r, rank, name = (np.concatenate(x) for x in zip(*found, strict=True))
        cell = r * coordinates + (name % np.uint64(coordinates)).astype(np.int64)
        order = np.lexsort((name, rank, cell))
        cell, name = cell[order], name[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        out.reshape(-1)[cell[first]] = name[first] | np.uint64(1)
        full = np.bincount(cell[first] // coordinates, minlength=rows) == coordinates
        todo = todo[~full[todo]]
        reach[todo] *= 2
    return out


def _banded(signature: np.ndarray, bands: int, each: int) -> np.ndarray:
    out = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        acc = np.full(len(signature), b + 1, np.uint64)
        for c in range(each):
            acc = mix(acc * np.uint64(0xD1342543DE82EF95) + signature[:, b * each + c])
        out[:, b] = acc
    return out


def _sketch(bands: int, each: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in parts(batch.column(1), 2 << 20):
                texts = batch.column(1).slice(lo, hi - lo)
                row, h = shingles(lex(ALNUM, texts), k)
                row, strip = strips(row, h)
                n = hi - lo
                banded = _banded(signatures(row, strip, n, bands * each), bands, each).view(np.int64)
                has = np.bincount(row, minlength=n) > 0
                offsets = np.concatenate([[0], np.cumsum(has * bands)]).astype(np.int32)
                keys = [hashlib.md5((t.as_py() or "").encode()).digest() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(banded[has].reshape(-1)))], names=["id", "key", "bands"]
                )

    return run


def weighted_jaccard(a: pa.Array, b: pa.Array, k: int) -> np.ndarray:
    """Of the texts of two columns, row by row."""
    n = len(a)
    ra, sa = strips(*shingles(lex(ALNUM, a), k))
    rb, sb = strips(*shingles(lex(ALNUM, b), k))
    row, strip = np.concatenate([ra, rb]), np.concatenate([sa, sb])
    order = np.lexsort((strip, row))
    row, strip = row[order], strip[order]
    both = (row[1:] == row[:-1]) & (strip[1:] == strip[:-1])
    shared = np.bincount(row[1:][both], minlength=n)
    return shared / np.maximum(np.bincount(row, minlength=n) - shared, 1)


def _verified(pairs: DataFrame, texts: DataFrame, k: int, least: float) -> DataFrame:
    """Of pairs (u, v) those that are similar enough.  texts: (id, text)."""
    u = texts.select(F.col("id").alias("_u"), F.col("text").alias("ut"))
    v = texts.select(F.col("id").alias("_v"), F.col("text").alias("vt"))
    both = pairs.hint("merge").join(u, F.col("u") == F.col("_u")).select("u", "v", "ut").hint("merge").join(v, F.col("v") == F.col("_v"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in parts(batch.column(2), 2 << 20):
                part = batch.slice(lo, hi - lo)
                good = weighted_jaccard(part.column(2), part.column(3), k) >= least
                yield part.select([0, 1]).filter(pa.array(good))

    return both.select("u", "v", "ut", "vt").mapInArrow(test, pairs.schema)


def digest(text: Column) -> Column:
    """The name of a text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _strip_rows(k: int):
    """(key, text) -> key, strip and the number of strips of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in parts(batch.column(1), 2 << 20):
                row, strip = strips(*shingles(lex(ALNUM, batch.column(1).slice(lo, hi - lo)), k))
                n = np.bincount(row, minlength=hi - lo)
                key = batch.column(0).slice(lo, hi - lo).take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([key, pa.array(strip.view(np.int64)), pa.array(n[row], pa.int32())], names=["key", "strip", "n"])

    return run


def _up(x: Column) -> Column:
    """The next whole number, whatever a float's last digits say."""
    return F.ceil(x - 1e-9)


def prefixes(texts: DataFrame, k: int, least: float) -> DataFrame:
    """(key, strip, n, own, at, short) of the strips by which a text meets others.

    texts: (key, text).  ``at`` is the strip's place by rising frequency, ``own``
    the number of strips that no other text has, ``short`` whether the strip is in
    the prefix towards texts that are as long or longer.
    """
    rows = texts.mapInArrow(_strip_rows(k), "key binary, strip bigint, n int")
    common = rows.groupBy("strip").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = rows.join(common.withColumnRenamed("strip", "_strip").hint("merge"), F.col("strip") == F.col("_strip"))
    lists = shared.groupBy("key").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "strip"))).alias("s"))  # a text's own strips bound its list
    n, own = F.col("n"), F.col("n") - F.size("s")
    longest = n - _up(n * least) + 1 - own
    out = lists.filter(longest > 0).select("key", "n", own.alias("own"), F.posexplode(F.slice("s", F.lit(1), longest.cast("int"))).alias("at", "s"))
    return out.select("key", F.col("s.strip").alias("strip"), "n", "own", (F.col("own") + F.col("at")).alias("at"), (F.col("own") + F.col("at") < n - _up(n * (2 * least / (1 + least))) + 1).alias("short"))


def _labelled(df: DataFrame, column: str, found: DataFrame) -> DataFrame:
    """``df`` with the component of a node as ``comp``."""
    label = found.select(F.col("u").alias("_u"), F.col("v").alias("_low"))
    return df.join(label, F.col(column) == F.col("_u"), "left").withColumn("comp", F.coalesce("_low", column)).drop("_u", "_low")


def _linked(buckets: DataFrame, texts: DataFrame, k: int, least: float) -> DataFrame:
    """(u, v) for every text but the lowest of its class.  buckets: (band, key); texts: (key, text)."""
    named = texts.select(F.col("key").alias("id"), "text")
    low = buckets.groupBy(F.col("band").alias("_band")).agg(F.min("key").alias("u"))
    stars = buckets.join(low, F.col("band") == F.col("_band")).filter("u <> key").select("u", F.col("key").alias("v")).distinct()
    links = keep(_verified(stars, named, k, least), "links")
    found = components(links)

    comps = _labelled(buckets, "key", found)
    mixed = comps.groupBy(F.col("band").alias("_band")).agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b").select("_band")
    left = comps.join(mixed, F.col("band") == F.col("_band"), "left_semi").select(F.col("key").alias("_key")).distinct()
    some = texts.join(left.hint("merge"), F.col("key") == F.col("_key"), "left_semi")
    meets = keep(prefixes(some, k, least), "meets")

    centre = meets.groupBy(F.col("strip").alias("_strip")).agg(F.min(F.struct("own", "key"))["key"].alias("u"))
    pairs = _labelled(meets.select("strip", "key"), "key", found).join(_labelled(centre, "u", found).withColumnRenamed("comp", "_comp"), F.col("strip") == F.col("_strip"))
    pairs = pairs.filter("comp <> _comp").select("u", F.col("key").alias("v")).distinct()
    links = links.union(keep(_verified(pairs, named, k, least), "links"))
    found = components(links)

    comps = keep(_labelled(meets, "key", found), "meets")
    i = comps.filter("short").select(F.col("strip").alias("_strip"), F.col("key").alias("u"), F.col("n").alias("_n"), F.col("at").alias("_at"), F.col("comp").alias("_comp"))
    room = F.least(F.col("n") - F.col("at"), F.col("_n") - F.col("_at")) >= _up((F.col("n") + F.col("_n")) * (least / (1 + least)))
    order = (F.col("_n") < F.col("n")) | ((F.col("_n") == F.col("n")) & (F.col("u") < F.col("key")))
    pairs = comps.join(i, (F.col("strip") == F.col("_strip")) & (F.col("comp") != F.col("_comp")) & order & (F.col("_n") >= F.col("n") * least - 1e-9) & room)
    pairs = pairs.select("u", F.col("key").alias("v")).distinct()
    return components(links.union(keep(_verified(pairs, named, k, least), "links")))


def classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY, bands: int = BANDS, each: int = ROWS, k: int = WORDS) -> DataFrame:
    """(doc_id, key, class, class_id) for every row.

    ``key`` is the text's digest, ``class`` the lowest one of the row's class, and
    ``class_id`` the lowest id of that class.
    """
    kind = df.schema[doc_id].dataType.simpleString()
    docs = df.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    sketch = keep(docs.mapInArrow(_sketch(bands, each, k), f"id {kind}, key binary, bands array<bigint>"), "sketch")
    nodes = sketch.groupBy("key", "bands").agg(F.min("id").alias("rep"))  # equal texts have equal bands
    banded = keep(nodes.select("key", F.explode("bands").alias("band")), "banded")
    shared = banded.groupBy(F.col("band").alias("_band")).agg(F.min("key").alias("low"), F.max("key").alias("top")).filter("low <> top")
    buckets = keep(banded.join(shared, F.col("band") == F.col("_band"), "left_semi"), "buckets")
    wanted = buckets.select(F.col("key").alias("_key")).distinct()
    # merge joins at every size: else the plan, and what it shuffles, would change with the table's
    named = docs.select(digest(F.col("text")).alias("key"), "text").join(wanted.hint("merge"), F.col("key") == F.col("_key"), "left_semi")
    texts = keep(named.groupBy("key").agg(F.first("text").alias("text")), "texts")
    found = _linked(buckets, texts, k, least)
    label = found.select(F.col("u").alias("_u"), F.col("v").alias("_low"))
    rows = keep(sketch.select("id", "key").join(label.hint("merge"), F.col("key") == F.col("_u"), "left").select("id", "key", F.coalesce("_low", "key").alias("class")), "classed")
    # written, so that the join below deals both sides and can split a hot class
    names = keep(rows.groupBy(F.col("class").alias("_class")).agg(F.min("id").alias("class_id")), "names")
    return rows.join(names.hint("merge"), F.col("class") == F.col("_class")).select(F.col("id").alias("doc_id"), "key", "class", "class_id")


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near-duplicates of every document; its lowest id is kept."""
    found = classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each class, of the lowest id, then the lowest digest.

    Rows with an id come before those without; of rows of one id and text the one
    with the lowest hash of all columns stays.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    found = keep(classes(docs), "classes")
    chosen = found.groupBy("class").agg(first).select(F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key"))
    times = found.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("_n"))
    chosen = chosen.join(times.hint("merge"), F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("key"))).select("_id", "_key", "_n")
    rows = docs.select(F.struct("*").alias("row"), digest(F.col("text")).alias("key"))
    kept = rows.join(keep(chosen, "chosen").hint("merge"), (F.col("key") == F.col("_key")) & F.col("row.doc_id").eqNullSafe(F.col("_id")))
    once = kept.filter("_n = 1").select("row")
    again = kept.filter("_n > 1").groupBy("_id", "_key").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row")
    return once.union(again).select("row.*")
