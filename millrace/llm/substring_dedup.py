"""Repeated passages by collinear chaining of shared k-mer seeds.

1. Seeds: of every 16 adjacent 8-word k-mers of a text the lowest hash
   (minimizers), so any 23 shared words share a seed, wherever they stand.  Of
   equal hashes one in 16 places is taken, and a seed that comes again within a
   few words is numbered, so a periodic text matches another in order, as far as
   the other reaches.
2. Join: a seed that several documents hold is matched to its first document,
   the one of the lowest id, so matches grow with the seeds and not with pairs.
3. Chain: the matches of a document with another are points (x, y).  A chain's
   score is its matches less a cost for the gaps, the best predecessor with a
   smaller x and y comes from a Fenwick tree of prefix maxima.
4. Align: the words around a chain, of both documents, are aligned seed by seed,
   greedily outwards and by common subsequences in the gaps.  Spans with a
   similarity of 0.8 or more are repeats; of a chain that is less alike as a
   whole, its longest parts that are.
5. A passage whose seeds have different first documents comes in several spans:
   spans of a document that touch are one, and from ``MIN_WORDS`` words it counts.

A document's passages that an earlier document also holds are its repeats; the
earliest holder keeps the passage.  Ends are judged against the first holder: a
word beyond them that only a later holder shares, by chance, stays.

Words are runs of letters and digits, A-Z folded.  Defined cases: null, empty
and shorter texts have no seeds and no repeats; repeated rows of an id are one
document; a passage twice in one document only is no repeat; a null id neither
holds nor repeats a passage; ties of positions take the first; an empty table
gives an empty one; extra columns are untouched.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.decontaminate import merged
from millrace.llm.scratch import keep
from millrace.llm.words import ALNUM, lex, mix, parts, windows

K = 8
WINDOW = 16
#: Words that a passage has at least.
MIN_WORDS = 50
SIMILARITY = 0.8
#: Words that a span has at least, alone or as a part of a passage.
MIN_SPAN = 16
#: A seed that comes again within so many words is periodic; a longer unit is a copy of its own.
PERIOD = K + WINDOW
#: A chain ends where either document skips more words than this.
MAX_GAP = 64
#: Words beyond a chain's ends that alignment may claim.
REACH = K + WINDOW + 8
#: Cost of a skipped word, in matched words; over the longest gap less than a seed is worth.
GAP_COST = 0.05


def minimizers(row: np.ndarray, h: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of k-mers that are lowest in some run of ``window``."""
    g, at = windows(row, h, k)
    if not len(g):
        return g, at
    owner = row[at]
    first = np.ones(len(g), bool)
    first[1:] = owner[1:] != owner[:-1]
    local = np.arange(len(g)) - np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
    kmer, g = g, (g & ~np.uint64(255)) | (local % window).astype(np.uint64)  # places decide between equal hashes
    slot = np.arange(len(g)) + (np.cumsum(first) - 1) * (window - 1)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    low = np.full(slot[-1] + window, top, np.uint64)
    low[slot] = g
    span = 1
    while span < window:
        step = min(span, window - span)
        low[:-step] = np.minimum(low[:-step], low[step:])
        span += step
    # windows that start in a text and end in it, or the only one of a short text
    last = np.append(first[1:], True)
    end = np.repeat(np.flatnonzero(last), np.diff(np.append(np.flatnonzero(first), len(g))))
    starts = (np.arange(len(g)) + window - 1 <= end) | first
    best = np.zeros(len(low), np.uint64)
    best[slot[starts]] = low[slot[starts]]
    span = 1
    while span < window:
        step = min(span, window - span)
        best[step:] = np.maximum(best[step:], best[:-step].copy())
        span += step
    chosen = best[slot] == g
    return kmer[chosen], at[chosen]


def numbered(row: np.ndarray, h: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, hash): seeds by text, hash and place, with their number in a run of close equal ones."""
    order = np.lexsort((pos, h, row))
    r, g, p = row[order], h[order], pos[order]
    again = np.zeros(len(g), bool)
    again[1:] = (g[1:] == g[:-1]) & (r[1:] == r[:-1]) & (p[1:] - p[:-1] <= PERIOD)
    number = np.arange(len(g)) - np.maximum.accumulate(np.where(again, 0, np.arange(len(g))))
    return order, mix(g + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in parts(batch.column(1)):
            words = lex(ALNUM, batch.column(1).slice(lo, hi - lo))
            h, at = minimizers(words.row, words.hash)
            row = words.row[at]
            pos = at - words.bounds()[row]
            order, h = numbered(row, h, pos)
            row, pos = row[order], pos[order]
            order = np.lexsort((pos, h, row))
            row, h, pos = row[order], h[order], pos[order]
            lead = np.ones(len(h), bool)
            lead[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            ids = batch.column(0).slice(lo, hi - lo).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), ids, pa.array(pos.astype(np.int32)), pa.array(lead)], names=["h", "doc", "pos", "lead"])


class Fenwick:
    """Prefix maxima of (score, index) over 1..n."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(-1e18, -1)] * (n + 1)

    def put(self, at: int, value: tuple[float, int]) -> None:
        best = self.best
        while at < len(best):
            if best[at] < value:
                best[at] = value
            at += at & -at

    def upto(self, at: int) -> tuple[float, int]:
        best, out = self.best, (-1e18, -1)
        while at:
            if best[at] > out:
                out = best[at]
            at &= at - 1
        return out


def chains(xs: list[int], ys: list[int], k: int = K, max_gap: int = MAX_GAP, cost: float = GAP_COST) -> list[list[int]]:
    """Disjoint chains of the points, as indices by rising x.

    A chain's value at a point is k plus the best value of a point lower left,
    less the cost of the words skipped in both; adding cost * (x + y) to the
    values makes that a prefix maximum.  Where the maximum lies beyond ``max_gap``
    in x or y, the points within it are compared one by one: a place of a text has
    one seed, so they are ``max_gap`` at most.
    """
    order = sorted(range(len(xs)), key=lambda i: (xs[i], ys[i]))
    rank = {y: i + 1 for i, y in enumerate(sorted(set(ys)))}
    tree = Fenwick(len(rank))
    back: dict[int, int] = {}
    value: dict[int, float] = {}
    near: deque[int] = deque()  # points before x, within max_gap
    same: list[int] = []  # points at x
    for n, i in enumerate(order):
        x, y = xs[i], ys[i]
        score, j = tree.upto(rank[y] - 1)
        gain = score - cost * (x + y) if j >= 0 else -1.0
        while near and x - xs[near[0]] > max_gap:
            near.popleft()
        if gain > 0 and (x - xs[j] > max_gap or y - ys[j] > max_gap):
            gain, j = max(((value[g] - cost * (x - xs[g] + y - ys[g]), g) for g in near if 0 < y - ys[g] <= max_gap), default=(-1.0, -1))
        value[i] = k + max(0.0, gain)
        if gain > 0:
            back[i] = j
        same.append(i)
        if n + 1 == len(order) or xs[order[n + 1]] != x:
            for g in same:
                tree.put(rank[ys[g]], (value[g] + cost * (xs[g] + ys[g]), g))
            near.extend(same)
            same = []
    out, used = [], set()
    for i in sorted(order, key=lambda i: -value[i]):
        chain = []
        while i is not None and i not in used:
            used.add(i)
            chain.append(i)
            i = back.get(i)
        if chain:
            out.append(chain[::-1])
    return out


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, other, lo, hi, olo, ohi, anchors = [], [], [], [], [], [], []
        lists = batch.column(1)
        flat, offsets = lists.flatten(), lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        pos, odoc, opos = (flat.field(i) for i in range(3))
        pos, opos = pos.to_numpy(), opos.to_numpy()
        names = pc.dictionary_encode(odoc)
        codes = names.indices.to_numpy()
        for d in range(len(batch)):
            mine = np.arange(offsets[d], offsets[d + 1])
            mine = mine[np.lexsort((opos[mine], pos[mine], codes[mine]))]
            cuts = np.flatnonzero(np.diff(codes[mine])) + 1
            for part in np.split(mine, cuts):
                x, y = pos[part].tolist(), opos[part].tolist()
                for chain in chains(x, y):
                    doc.append(d)
                    other.append(int(codes[part[0]]))
                    lo.append(x[chain[0]])
                    hi.append(x[chain[-1]] + K)
                    olo.append(y[chain[0]])
                    ohi.append(y[chain[-1]] + K)
                    anchors.append([v for i in chain for v in (x[i], y[i])])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(doc, pa.int64())), names.dictionary.take(pa.array(other, pa.int64())), *(pa.array(v, pa.int32()) for v in (lo, hi, olo, ohi)), pa.array(anchors, pa.list_(pa.int32()))],
            names=["doc", "other", "lo", "hi", "olo", "ohi", "anchors"],
        )


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes lo - REACH to hi + REACH of a document, as 32 bits each."""
    for batch in batches:
        ids = batch.column("id")
        fresh = np.ones(len(batch), bool)  # rows of a document follow each other: its text is read once
        fresh[1:] = pc.not_equal(ids.slice(1), ids.slice(0, len(batch) - 1)).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(fresh)
        texts = batch.column("text").take(pa.array(at))
        own = np.cumsum(fresh) - 1
        lo, hi = batch.column("lo").to_numpy(), batch.column("hi").to_numpy()
        for a, b in parts(texts):
            words = lex(ALNUM, texts.slice(a, b - a))
            bounds = words.bounds()
            short = (words.hash >> np.uint64(32)).astype("<u4")
            rows = np.flatnonzero((own >= a) & (own < b))
            out = []
            for i in rows.tolist():
                first, end = int(bounds[own[i] - a]), int(bounds[own[i] - a + 1])
                out.append(short[first + max(0, int(lo[i]) - REACH) : min(end, first + int(hi[i]) + REACH)].tobytes())
            part = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("lo"), part.column("hi"), pa.array(out, pa.binary())], names=["id", "lo", "hi", "words"])


def _gap(a: np.ndarray, b: np.ndarray) -> int:
    """Matched words in the longest common subsequence of two short gaps."""
    if not len(a) or not len(b):
        return 0
    if len(a) == len(b) and len(a) == 1:
        return int(a[0] == b[0])
    row = np.zeros(len(b) + 1, np.int32)
    for w in a:
        up = np.maximum(row[1:], row[:-1] + (b == w))
        row[1:] = np.maximum.accumulate(up)
    return int(row[-1])


def _outwards(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """(words of a, words of b, matches) by which an alignment may extend, best last.

    Runs of equal words, between which a single word differs, is missing or is
    added; an extension needs 4 equal words after such an edit.
    """
    i = j = n = 0
    steps = [(0, 0, 0)]
    while True:
        m = min(len(a) - i, len(b) - j)
        same = a[i : i + m] == b[j : j + m]
        run = m if same.all() else int(same.argmin())
        i, j, n = i + run, j + run, n + run
        if run:
            steps.append((i, j, n))
        for di, dj in ((1, 1), (1, 0), (0, 1)):
            x, y = a[i + di : i + di + 4], b[j + dj : j + dj + 4]
            if len(x) == len(y) == 4 and (x == y).all():
                i, j = i + di, j + dj
                break
        else:
            return steps


def align(a: np.ndarray, b: np.ndarray, anchors: list[tuple[int, int]], k: int = K, least: float = SIMILARITY) -> tuple[int, int, int] | None:
    """(first word, last word + 1, matches) of the passage in ``a`` around a chain.

    None if the chain's two sides are less alike than ``least``.
    """
    x, y = anchors[0]
    start, ostart, matches = x, y, k
    x, y = x + k, y + k
    for p, q in anchors[1:]:
        over = max(0, x - p, y - q)  # words of this seed that the last one covers
        if over >= k:
            continue
        p, q = p + over, q + over
        matches += _gap(a[x:p], b[y:q]) + k - over
        x, y = p + k - over, q + k - over
    head = _outwards(a[:start][::-1], b[:ostart][::-1])[-1]
    tail = _outwards(a[x:], b[y:])[-1]
    lo, hi = start - head[0], x + tail[0]
    olo, ohi = ostart - head[1], y + tail[1]
    matches += head[2] + tail[2]
    if matches < least * max(hi - lo, ohi - olo):
        return None
    return lo, hi, matches


def pieces(a: np.ndarray, b: np.ndarray, anchors: list[tuple[int, int]], k: int = K, least: float = SIMILARITY) -> list[tuple[int, int, int]]:
    """(first word, last word + 1, matches) of the passages in ``a`` along a chain.

    A chain that is alike as a whole is one.  Of another the longest part that is
    alike is taken, then those of what stands before and after it.
    """
    if whole := align(a, b, anchors, k, least):
        return [whole]
    n = len(anchors)
    at = np.array(anchors)
    total, head, tail = np.zeros(n, np.int64), np.zeros((n, 3), np.int64), np.zeros((n, 3), np.int64)
    x = y = 0
    for i, (p, q) in enumerate(anchors):
        over = max(0, x - p, y - q) if i else 0
        before, other = a[x : p + over], b[y : q + over]
        head[i] = _outwards(before[::-1], other[::-1])[-1]
        if i:
            total[i] = total[i - 1] + _gap(before, other) + k - over
            tail[i - 1] = _outwards(before, other)[-1]
        x, y = p + k, q + k
    tail[-1] = _outwards(a[x:], b[y:])[-1]
    start, end = at - head[:, :2], at + k + tail[:, :2]
    far = np.zeros(n, np.int64)
    out, todo, stale = [], [(0, n)], np.ones(n, bool)
    while todo:
        lo, hi = todo.pop()
        for i in np.flatnonzero(stale[lo:hi] | (far[lo:hi] >= hi)) + lo:
            matches = k + total[i:hi] - total[i] + head[i, 2] + tail[i:hi, 2]
            good = np.flatnonzero(matches >= least * (end[i:hi] - start[i]).max(axis=1))
            far[i], stale[i] = (i + good[-1], False) if len(good) else (i, False)
        if lo == hi:
            continue
        length = end[far[lo:hi], 0] - start[lo:hi, 0]
        i = lo + int(length.argmax())
        if length.max() < MIN_SPAN:
            continue
        j = int(far[i])
        if found := align(a, b, anchors[i : j + 1], k, least):
            out.append(found)
        todo += [(lo, i), (j + 1, hi)]
    return sorted(out)


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep_rows, spans = [], []
        columns = {n: batch.column(n) for n in batch.schema.names}
        for i in range(len(batch)):
            a = np.frombuffer(columns["awords"][i].as_py(), "<u4")
            b = np.frombuffer(columns["bwords"][i].as_py(), "<u4")
            sa, sb = max(0, columns["lo"][i].as_py() - REACH), max(0, columns["olo"][i].as_py() - REACH)
            flat = columns["anchors"][i].as_py()
            for found in pieces(a, b, [(x - sa, y - sb) for x, y in zip(flat[::2], flat[1::2], strict=True)]):
                if found[1] - found[0] >= MIN_SPAN:
                    keep_rows.append(i)
                    spans.append((found[0] + sa, found[1] + sa, found[2]))
        cols = list(zip(*spans, strict=True)) or [[], [], []]
        at = pa.array(keep_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([columns["doc"].take(at), columns["other"].take(at), *(pa.array(c, pa.int32()) for c in cols)], names=["doc", "other", "first", "last", "matches"])


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        flat, offsets = lists.flatten(), lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        lo, hi = flat.field(1).to_numpy(), flat.field(2).to_numpy()
        good = np.zeros(len(flat), bool)
        for d in range(len(batch)):
            mine = np.arange(offsets[d], offsets[d + 1])
            mine = mine[np.argsort(lo[mine], kind="stable")]
            reach = np.maximum.accumulate(hi[mine])
            group = np.concatenate([[0], np.cumsum(lo[mine][1:] > reach[:-1])])
            edges = np.flatnonzero(np.diff(group)) + 1
            for part in np.split(mine, edges):
                good[part] = hi[part].max() - lo[part].min() >= MIN_WORDS
        owner = pa.array(np.repeat(np.arange(len(batch)), np.diff(offsets))[good])
        at = pa.array(np.flatnonzero(good))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), *(flat.field(i).take(at) for i in range(4))], names=["doc", "other", "first", "last", "matches"])


def repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, other, first, last, matches): words first to last of ``doc`` stand in ``other`` too."""
    kind = df.schema[doc_id].dataType.simpleString()
    docs = df.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).filter("id IS NOT NULL")
    seeds = docs.mapInArrow(_seeds, f"h bigint, doc {kind}, pos int, lead boolean")
    first = seeds.filter("lead").groupBy("h").agg(F.min("doc").alias("other"), F.min_by("pos", "doc").alias("opos"), F.max("doc").alias("top"))
    first = keep(first.filter("other <> top").select(F.col("h").alias("_h"), "other", "opos"), "first")
    # merge joins at every size: else the plan, and what it shuffles, would change with the table's
    hits = seeds.join(first.hint("merge"), F.col("h") == F.col("_h")).filter("doc <> other").select("doc", F.struct("pos", "other", "opos").alias("m"))
    lists = hits.groupBy("doc").agg(F.collect_set("m").alias("m"))  # a document's own seeds bound its list
    schema = f"doc {kind}, other {kind}, lo int, hi int, olo int, ohi int, anchors array<int>"
    found = keep(lists.mapInArrow(_chained, schema), "chains")
    asked = found.select(F.col("doc").alias("_id"), "lo", "hi").union(found.select("other", "olo", "ohi")).distinct()
    joined = asked.hint("merge").join(docs, F.col("_id") == F.col("id")).select("id", "lo", "hi", "text").sortWithinPartitions("id")
    slices = keep(joined.mapInArrow(_sliced, f"id {kind}, lo int, hi int, words binary"), "slices")
    a = slices.select(F.col("id").alias("_a"), F.col("lo").alias("_alo"), F.col("hi").alias("_ahi"), F.col("words").alias("awords"))
    b = slices.select(F.col("id").alias("_b"), F.col("lo").alias("_blo"), F.col("hi").alias("_bhi"), F.col("words").alias("bwords"))
    both = found.select("doc", "other", "anchors", "lo", "hi", "olo", "ohi")
    both = both.join(a.hint("merge"), (F.col("doc") == F.col("_a")) & (F.col("lo") == F.col("_alo")) & (F.col("hi") == F.col("_ahi")))
    both = both.join(b.hint("merge"), (F.col("other") == F.col("_b")) & (F.col("olo") == F.col("_blo")) & (F.col("ohi") == F.col("_bhi")))
    both = both.select("doc", "other", "anchors", "lo", "awords", "olo", "bwords")
    schema = f"doc {kind}, other {kind}, first int, last int, matches int"
    spans = both.mapInArrow(_aligned, schema).groupBy("doc").agg(F.collect_set(F.struct("other", "first", "last", "matches")).alias("s"))
    return spans.mapInArrow(_passages, schema)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated passages of all documents, each with an earlier holder."""
    found = repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(F.col("doc").alias("doc_id"), F.col("other").alias("earlier_doc_id"), F.col("first").alias("first_word"), (F.col("last") - F.col("first")).alias("n_words"), F.col("matches").alias("n_matched"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, without passages that an earlier one holds."""
    spans = repeats(docs).groupBy("doc").agg(F.collect_set(F.struct("first", "last")).alias("_spans"))
    spans = keep(spans.withColumnRenamed("doc", "_doc"), "spans")
    names = docs.columns
    field, count = names.index("text"), names.index("n_chars") if "n_chars" in names else -1
    joined = docs.select(F.struct("*").alias("row")).join(spans.hint("merge"), F.col("row.doc_id") == F.col("_doc"), "left").select("row", "_spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, own = batch.column(0), batch.column(1)
            columns = rows.flatten()
            touched = np.flatnonzero(own.is_valid().to_numpy(zero_copy_only=False))
            texts = columns[field].take(pa.array(touched))
            words = lex(ALNUM, texts)
            bounds = words.bounds()
            new = columns[field].to_pylist() if len(touched) else None
            for n, i in enumerate(touched.tolist()):
                body, out, at = texts[n].as_py().encode(), [], 0
                for s, e in merged([(x["first"], x["last"]) for x in own[i].as_py()]):
                    out.append(body[at : words.start[bounds[n] + s]])
                    at = int(words.end[bounds[n] + e - 1])
                new[i] = b"".join([*out, body[at:]]).decode()
            if new is not None:
                columns[field] = pa.array(new, columns[field].type)
                if count >= 0:
                    columns[count] = pc.utf8_length(columns[field]).cast(columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(cut, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema.fields]))
