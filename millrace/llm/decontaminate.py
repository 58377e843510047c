"""Benchmark decontamination with one FM-index per training shard.

The phrases are the benchmark's windows of 13 words; an item of fewer words, but
not none, is one phrase.  A shard is some megabytes of documents of a partition.  Its index is
built over words as symbols of the phrases' own vocabulary.  No phrase crosses a
word outside that vocabulary, so a run of such words is one separator, and runs
shorter than the shortest phrase are left out: both lose no occurrence.  All
phrases are searched backwards at once, occurrences are located by sampled
suffixes, and their word spans merged.

The benchmark is broadcast in slices of a bounded number of bytes.  A phrase is two
offsets into its slice's words, so a slice is a few times its text.  The driver makes
them one after the other, and a worker that holds a shard has one at a time; the
documents pass once, without a shuffle.

Defined cases: null and empty texts have no words and no hits; items without
words are ignored; a null item id is the empty string; repeated items count once
by their id; every document row is judged by itself; an empty table, either one,
gives an empty table or no hits; extra columns travel inside ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.fm_index import FMIndex
from millrace.llm.words import ALNUM, Words, lex, parts, windows

#: Words in a window.
WINDOW = 13
#: Bytes of benchmark text that one broadcast slice holds, about.
SLICE_BYTES = 8 << 20
#: Bytes of documents that one index is built over, about.
SHARD_BYTES = 8 << 20

_SPAN = "array<struct<start:bigint,end:bigint>>"


class Phrases:
    """A slice of the benchmark as phrases over its own vocabulary."""

    def __init__(self, items: list[tuple[str, str | None]], n: int = WINDOW):
        words = ALNUM.words([text for _, text in items])
        names, item = np.unique(np.array([name for name, _ in items], dtype=object), return_inverse=True) if items else (np.zeros(0, object), np.zeros(0, int))
        self.names = names.tolist()
        self.vocabulary, symbols = np.unique(words.hash, return_inverse=True)
        self.flat = (symbols + 2).astype(np.int32)  # 0 ends, 1 separates
        bounds = words.bounds()
        counts = np.diff(bounds)
        h, at = windows(words.row, words.hash, n)
        short = np.flatnonzero((counts > 0) & (counts < n))
        starts = np.concatenate([at, bounds[short]]).astype(np.int32)
        length = np.concatenate([np.full(len(at), n), counts[short]]).astype(np.int32)
        order = np.lexsort((starts, np.concatenate([h, words.hash[bounds[short]]]), length))
        starts, length = starts[order], length[order]
        # the same words again are the same phrase
        same = np.append(False, length[1:] == length[:-1])[: len(length)]
        for k in range(n):
            i = np.flatnonzero(same & (length > k))
            same[i] = self.flat[starts[i] + k] == self.flat[starts[i - 1] + k]
        fresh = np.flatnonzero(~same)
        self.starts, self.lengths = starts[fresh], length[fresh]
        self.owners = item[words.row[starts]].astype(np.int32)  # of phrase i: owners[first[i]:first[i + 1]]
        self.first = np.append(fresh, len(starts)).astype(np.int32)
        self.shortest = int(length.min()) if len(length) else 0

    def occurrences(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first word) of every occurrence."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not self.shortest or not len(words.row):
            return none
        at = np.minimum(np.searchsorted(self.vocabulary, words.hash), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == words.hash
        opens = known.copy()
        opens[1:] &= ~known[:-1] | (words.row[1:] != words.row[:-1])
        run = np.cumsum(opens) - 1
        kept = known & (np.bincount(run[known], minlength=int(run[-1]) + 1)[run] >= self.shortest) if known.any() else known
        place = np.flatnonzero(kept)
        if not len(place):
            return none
        shift = np.cumsum(opens[place] | (np.arange(len(place)) == 0))
        slot = np.arange(len(place)) + shift - 1
        text = np.ones(slot[-1] + 2, np.int64)
        text[slot] = at[place] + 2
        back = np.zeros(len(text), np.int64)
        back[slot] = place
        index = FMIndex(text, len(self.vocabulary) + 2)
        phrase, position = index.locate(*index.search(self.flat, self.starts, self.starts + self.lengths))
        return phrase, back[position]

    def hits(self, words: Words) -> tuple[np.ndarray, list[tuple[int, str]]]:
        """Which words stand in an occurrence, and (row, item) of those found."""
        phrase, first = self.occurrences(words)
        if not len(phrase):
            return np.zeros(len(words.row), bool), []
        edge = np.zeros(len(words.row) + 1, np.int64)
        np.add.at(edge, first, 1)
        np.add.at(edge, first + self.lengths[phrase], -1)
        pairs = np.unique(words.row[first] * len(self.first) + phrase)  # a phrase of a text once
        row, phrase = pairs // len(self.first), pairs % len(self.first)
        n = self.first[phrase + 1] - self.first[phrase]
        owner = self.owners[np.repeat(self.first[phrase] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        found = np.unique(np.repeat(row, n) * max(1, len(self.names)) + owner)
        return np.cumsum(edge[:-1]) > 0, [(int(x) // len(self.names), self.names[int(x) % len(self.names)]) for x in found]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of byte spans, in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _slices(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[str, str | None]]]:
    rows = benchmark.select(F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("i"), F.col(f"`{text}`").alias("t"))
    total = rows.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0
    n = max(1, -(-total // SLICE_BYTES))
    for k in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("i"), F.lit(n)) == k)
        yield [(r.i, r.t) for r in part.collect()]


def _scanned(batch: pa.RecordBatch, field: int, slices: list, names: list[str]) -> pa.RecordBatch:
    """A shard with what the benchmark's slices have there."""
    words = lex(ALNUM, pc.struct_field(batch.column(0), [field]))
    hit, found = np.zeros(len(words.row), bool), [set() for _ in range(words.rows)]
    for one in slices:
        own, items = one.value.hits(words)
        hit |= own
        for row, name in items:
            found[row].add(name)
        if len(slices) > 1:
            del one._value  # read again for the next shard: a worker holds one slice
    other = words.row[1:] != words.row[:-1]
    begins, ends = hit.copy(), hit.copy()
    begins[1:] &= ~hit[:-1] | other
    ends[:-1] &= ~hit[1:] | other
    spans = pa.StructArray.from_arrays([pa.array(words.start[begins], pa.int64()), pa.array(words.end[ends], pa.int64())], names=["start", "end"])
    offsets = np.searchsorted(words.row[begins], np.arange(words.rows + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array(np.bincount(words.row, minlength=words.rows), pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), spans),
            pa.array(np.bincount(words.row[hit], minlength=words.rows), pa.int64()),
            pa.array([sorted(x) for x in found], pa.list_(pa.string())),
        ],
        names=names,
    )


def find_contamination(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", n: int = WINDOW) -> DataFrame:
    """``row``, the input row as a struct, n_words, spans (merged bytes of hit words), n_hit, items."""
    context = df.sparkSession.sparkContext
    rows = df.select(F.struct("*").alias("row"))
    field = df.columns.index(text)
    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string(f"n_words bigint, spans {_SPAN}, n_hit bigint, items array<string>").fields])
    slices = [context.broadcast(Phrases(items, n)) for items in _slices(benchmark, item, item_text)]  # each of bounded size

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo, hi in parts(pc.struct_field(whole.column(0), [field]), SHARD_BYTES):
                yield _scanned(whole.slice(lo, hi - lo), field, slices, schema.names)

    return rows.mapInArrow(scan, schema)


def contaminated() -> F.Column:
    """The rule: a twentieth of the words or more are hit."""
    return (F.col("n_hit") > 0) & (F.lit(20) * F.col("n_hit") >= F.col("n_words"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and found items of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rule calls clean, as they are."""
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(~contaminated()).select("row.*")


SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
dg AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM p)),
h AS (SELECT g.doc_id, g.i, g.n, p.item_id FROM dg AS g JOIN p ON p.n = g.n AND p.s = array_to_string(g.w[g.i:g.i + g.n - 1], ' ')),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM dw AS d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id"""
