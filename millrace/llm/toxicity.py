"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

The examples are a bounded sample of labelled rows (``EXAMPLES``, the lowest hashes
of their ids, a row an id).  Terms are all words of the examples, A-Z folded, and
those beginnings of words that tell their label: likelihood ratio ``TELLING`` or
more.  A text's vector has all its terms, each weighed by its frequency in the text,
its inverse document frequency over the whole corpus, and its relevance: one and the
likelihood ratio with which it raises the label among the examples.  Words that no
example has are outside the space.

The examples stand in an inverted index of blocks.  Postings of rare terms are summed
at once.  For each frequent term a block knows its largest weight there, so a query's
products with these, and the largest sum of rare terms, bound its cosine with any
example of the block.  Blocks are read by falling bound until no bound reaches the
k-th best cosine found: the neighbours are exact, and they are the evidence.  Their
labels vote by the inverse of their distance.  Votes of the examples, each left out
of its own neighbours, made monotone by pooling adjacent violators, turn votes into
probabilities.  Texts without any term get the share of toxic examples.

Defined cases: null and empty texts have no terms; labels that are null, or
whose id has no document, are ignored; of repeated labels the highest counts, of
several texts of a labelled id the one of the lowest hash; without usable labels
every score is 0.0; neighbours of equal cosine enter by their order in the index;
repeated rows are scored alike; an empty table gives an empty one; extra columns are
left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.scratch import keep
from millrace.llm.words import ALNUM, lex, parts

#: Labelled rows that are looked at, at most.
EXAMPLES = 8192
#: Bytes of the word beginnings that can be terms, and the likelihood ratio that each needs.
PREFIXES, TELLING = (4, 5, 6, 7), 10.0
NEIGHBOURS = 15
BLOCK = 64
#: Examples that a frequent term has at least: its weights stand in a row, with a place for each example.
FREQUENT = 128
#: What is added to a distance before it is inverted.
NEAR = 0.1
#: Strength of the prior in votes and probabilities, in neighbours.
PRIOR = 0.5
#: Neighbours that are returned as evidence.
EVIDENCE = 3


def _spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All places of ranges that begin at ``start`` and are ``n`` long."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _counted(texts: pa.Array, beginnings: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term hash, occurrences), sorted by both.  beginnings: those that are terms; None for these only, all of them."""
    words = lex(ALNUM, texts, PREFIXES if beginnings is None or len(beginnings) else ())
    row, h = ([], []) if beginnings is None else ([words.row], [words.hash])
    for some in words.prefix.values():
        own = some != 0
        if beginnings is not None:
            at = np.minimum(np.searchsorted(beginnings, some), len(beginnings) - 1)
            own &= beginnings[at] == some
        row.append(words.row[own])
        h.append(some[own])
    row, h = np.concatenate(row), np.concatenate(h)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(fresh)
    return row[at], h[at], np.diff(np.append(at, len(h)))


def ratio(n: np.ndarray, t: np.ndarray, rows: int, toxic: int) -> np.ndarray:
    """Likelihood ratio of a term's two-by-two table, 0 where it lowers the label."""

    def part(seen, total, whole):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) * rows / np.maximum(total * whole, 1)), 0.0)

    both = part(t, n, toxic) + part(n - t, n, rows - toxic) + part(toxic - t, rows - n, toxic) + part(rows - toxic - n + t, rows - n, rows - toxic)
    return np.where(t * rows > n * toxic, np.maximum(2 * both, 0), 0.0)


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, toxic -> beginning of words, rows and toxic rows that have it."""
    for batch in batches:
        row, h, _ = _counted(batch.column(0), None)
        terms, at = np.unique(h, return_inverse=True)
        t = np.bincount(at, batch.column(1).to_numpy()[row], len(terms)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(np.bincount(at, minlength=len(terms)), pa.int64()), pa.array(t)], names=["h", "n", "t"])


def _vectors(beginnings: np.ndarray):
    """(id, toxic, text) -> id, toxic, term hashes and their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, h, tf = _counted(batch.column(2), beginnings)
            offsets = pa.array(np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (pa.array(h.view(np.int64)), pa.array(tf.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["id", "toxic", "h", "tf"])

    return run


def _among(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The place of each value among sorted ones, -1 for others."""
    if not len(sorted_values):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return np.where(sorted_values[at] == x, at, -1)


def _known(texts: pa.Array, terms: np.ndarray, beginnings: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, occurrences) of the terms of texts, sorted by both."""
    words = lex(ALNUM, texts, PREFIXES if len(beginnings) else ())
    width = max(1, len(terms))
    at = _among(terms, words.hash)
    keys = [words.row[at >= 0] * width + at[at >= 0]]
    heads = np.zeros(1 << 16, bool)
    heads[beginnings >> np.uint64(48)] = True
    for some in words.prefix.values():
        maybe = np.flatnonzero(heads[some >> np.uint64(48)])  # few beginnings are terms
        own = maybe[_among(beginnings, some[maybe]) >= 0]
        keys.append(words.row[own] * width + _among(terms, some[own]))
    key, tf = np.unique(np.concatenate(keys), return_counts=True)
    return key // width, key % width, tf


def _document_frequencies(terms: np.ndarray, beginnings: np.ndarray):
    """text -> numbers of terms and of texts that have them, summed over a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(terms), np.int64)
        for batch in batches:
            for lo, hi in parts(batch.column(0), 2 << 20):
                n += np.bincount(_known(batch.column(0).slice(lo, hi - lo), terms, beginnings)[1], minlength=len(terms))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], names=["t", "n"])

    return run


class BlockMaxIndex:
    """Exact cosine neighbours among unit vectors, by blocks with largest weights.

    Vector i has terms[at[i]:at[i + 1]] with weights.  Postings are sorted by term.
    """

    def __init__(self, at: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int):
        size = len(at) - 1
        owner = np.repeat(np.arange(size, dtype=np.int32), np.diff(at))
        # alike ones in a block: by their commonest term, which tells the language, then by the heaviest
        spread = np.bincount(terms, minlength=n_terms)
        common, heaviest = np.full(size, -1), np.full(size, -1)
        some = np.flatnonzero(np.diff(at))
        for key, out in ((spread[terms], common), (weights, heaviest)):
            if len(some):
                top = np.flatnonzero(key == np.repeat(np.maximum.reduceat(key, at[some]), np.diff(at)[some]))
                out[owner[top[::-1]]] = terms[top[::-1]]  # of equal ones the first
        self.order = np.lexsort((np.arange(size), heaviest, common))
        place = np.empty(size, np.int32)
        place[self.order] = np.arange(size)
        self.size, self.blocks = size, -(-size // BLOCK)
        key = np.argsort(terms, kind="stable")
        self.place = place[owner[key]].astype(np.uint16 if size <= 1 << 16 else np.int32)
        self.weight = weights[key].astype(np.float32)
        self.term = np.append(0, np.cumsum(spread)).astype(np.int32)  # first posting of each term
        self.rows = self.largest = None

    def _unpack(self) -> None:
        """Rows of weights of the frequent terms, and their largest in each block; not shipped."""
        frequent = np.flatnonzero(np.diff(self.term) >= FREQUENT)
        self.row = np.full(len(self.term) - 1, -1, np.int32)
        self.row[frequent] = np.arange(len(frequent))
        self.rows = np.zeros((len(frequent), self.blocks, BLOCK), np.float32)
        n = self.term[frequent + 1] - self.term[frequent]
        some = _spread(self.term[frequent], n)
        self.rows[np.repeat(np.arange(len(frequent)), n), self.place[some] // BLOCK, self.place[some] % BLOCK] = self.weight[some]
        self.largest = self.rows.max(axis=2)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"rows": None, "largest": None, "row": None}

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, cosines) of the k nearest that share a term."""
        if self.rows is None:
            self._unpack()
        row = self.row[terms]
        rare, row, by = terms[row < 0], row[row >= 0], weights[row >= 0].astype(np.float32)
        n = self.term[rare + 1] - self.term[rare]
        at = _spread(self.term[rare], n)
        sums = np.bincount(self.place[at], self.weight[at] * np.repeat(weights[self.row[terms] < 0], n), self.blocks * BLOCK)
        bound = sums.reshape(self.blocks, BLOCK).max(axis=1) + by @ self.largest[row] + 1e-5 if self.blocks else sums  # weights have 24 bits
        order = np.argsort(-bound, kind="stable")
        place, cosine = np.zeros(0, np.int64), np.zeros(0)
        lo, hi = 0, min(8, self.blocks)
        while lo < hi:
            asked = np.sort(order[lo:hi])
            own = (asked[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            found = sums[own] + by @ self.rows[row[:, None], asked].reshape(len(row), len(own))
            new = np.flatnonzero(found > 0)
            if len(new) > 4 * k:
                new = new[np.argpartition(-found[new], 4 * k)[: 4 * k]] if found[new].min() < found[new].max() else new
                new = np.flatnonzero(found >= found[new].min())  # with all that equal the last of them
            place, cosine = np.concatenate([place, own[new]]), np.concatenate([cosine, found[new]])
            best = np.lexsort((place, -cosine))[:k]
            place, cosine = place[best], cosine[best]
            least = cosine[-1] if len(cosine) == k else 0.0
            lo, hi = hi, max(hi, int(np.searchsorted(-bound[order], -least, "right")))
        return place, cosine


class Model:
    """The index with its term weights."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, at: np.ndarray, h: np.ndarray, tf: np.ndarray, beginnings: np.ndarray):
        self.beginnings = beginnings
        self.terms = np.unique(h)
        self.term = np.searchsorted(self.terms, h).astype(np.int32)
        self.at, self.tf, self.ids, self.labels = at, tf, ids, labels
        self.share = float(labels.mean()) if len(labels) else 0.0

    def weigh(self, df: np.ndarray, documents: int) -> None:
        owner = np.repeat(np.arange(len(self.at) - 1, dtype=np.int32), np.diff(self.at))
        n = np.bincount(self.term, minlength=len(self.terms)).astype(float)
        t = np.bincount(self.term, self.labels[owner], len(self.terms)) if len(owner) else np.zeros(len(self.terms))
        self.weight = (np.log((1 + documents) / (1 + df)) + 1) * (1 + ratio(n, t, len(self.labels), int(self.labels.sum())))
        w = (1 + np.log(self.tf)) * self.weight[self.term]
        w /= np.sqrt(np.bincount(owner, w * w, len(self.at) - 1))[owner]
        del owner
        self.index = BlockMaxIndex(self.at, self.term, w, len(self.terms))
        self.ids, self.labels = self.ids[self.index.order], self.labels[self.index.order]
        del self.at, self.term, self.tf, self.index.order  # what is shipped is the index

    def vote(self, place: np.ndarray, cosine: np.ndarray) -> float:
        near = 1 / (NEAR + np.maximum(1 - cosine, 0))
        return float((near @ self.labels[place] + PRIOR * self.share) / (near.sum() + PRIOR))

    def left_out(self, terms: np.ndarray, weights: np.ndarray, own: int) -> float:
        """The vote of an example's neighbours without itself; own: its place in the index."""
        place, cosine = self.index.nearest(terms, weights, NEIGHBOURS + 1)
        other = place != own
        return self.vote(place[other][:NEIGHBOURS], cosine[other][:NEIGHBOURS])

    def queries(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(terms, unit weights) of each text."""
        row, at, tf = _known(texts, self.terms, self.beginnings)
        w = (1 + np.log(tf)) * self.weight[at] if len(self.terms) else np.zeros(0)
        bounds = np.searchsorted(row, np.arange(len(texts) + 1)).tolist()
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            yield at[lo:hi], w[lo:hi] / np.sqrt(w[lo:hi] @ w[lo:hi]) if hi > lo else w[lo:hi]

    def score(self, terms: np.ndarray, weights: np.ndarray, votes: np.ndarray, levels: np.ndarray) -> tuple[float, list, list[float], list[int]]:
        """Probability, and ids, cosines and labels of the nearest.  votes, levels: the calibration."""
        if not len(terms) or not len(votes):
            return self.share, [], [], []
        place, cosine = self.index.nearest(terms, weights, NEIGHBOURS)
        few = place[:EVIDENCE]
        return float(np.interp(self.vote(place, cosine), votes, levels)), self.ids[few].tolist(), cosine[:EVIDENCE].tolist(), self.labels[few].tolist()


def monotone(votes: np.ndarray, labels: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Vote levels and probabilities that rise with them, pooled and smoothed."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []  # sum of labels, count, sum of votes
    for v, y in zip(votes[order].tolist(), labels[order].tolist(), strict=True):
        pools.append([y, 1, v])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    level = [(p[0] + PRIOR * share) / (p[1] + PRIOR) for p in pools]
    return np.array([p[2] / p[1] for p in pools]), np.maximum.accumulate(np.array(level)) if level else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Broadcast, np.ndarray, np.ndarray]:
    """The model, broadcast, and its calibration.  docs: (id, text); labels: (id, toxic)."""
    spark = docs.sparkSession
    usable = labels.filter("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = keep(usable.orderBy(F.xxhash64("id"), "id").limit(EXAMPLES).withColumnRenamed("id", "_id"), "labelled")
    shown = docs.join(F.broadcast(sample), F.col("id") == F.col("_id"))  # at most EXAMPLES rows of two numbers
    shown = keep(shown.groupBy("id").agg(F.max("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text")), "examples")
    rows, toxic = shown.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counts = shown.select("text", F.col("toxic").cast("long")).mapInArrow(_beginnings, "h bigint, n bigint, t bigint").groupBy("h").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    some = counts.filter(F.col("t") * rows > F.col("n") * toxic).toArrow() if toxic else None  # bounded by the examples
    beginnings = np.zeros(0, np.uint64)
    if some is not None:
        n, t = (some.column(c).to_numpy() for c in ("n", "t"))
        beginnings = np.sort(some.column("h").to_numpy().view(np.uint64)[ratio(n, t, rows, toxic) >= TELLING])
    kind = docs.schema["id"].dataType.simpleString()
    found = shown.select("id", "toxic", "text").mapInArrow(_vectors(beginnings), f"id {kind}, toxic int, h array<bigint>, tf array<int>").orderBy("id").toArrow()  # EXAMPLES rows
    h, tf = (found.column(c).combine_chunks() for c in ("h", "tf"))
    at = np.concatenate([[0], np.cumsum(h.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64) if len(h) else np.zeros(1, np.int64)
    model = Model(np.array(found.column("id").to_pylist()), found.column("toxic").to_numpy().astype(np.int64), at, h.flatten().to_numpy().view(np.uint64), tf.flatten().to_numpy(), beginnings)
    df = np.zeros(len(model.terms))
    if len(model.terms):
        seen = docs.select("text").mapInArrow(_document_frequencies(model.terms, beginnings), "t int, n bigint").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
        df[seen.column("t").to_numpy()] = seen.column("n").to_numpy()
    model.weigh(df, docs.count())
    shared = spark.sparkContext.broadcast(model)  # bounded by EXAMPLES and their words

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {x: i for i, x in enumerate(shared.value.ids.tolist())}
        for batch in batches:
            own = [place[x] for x in batch.column(0).to_pylist()]
            votes = [shared.value.left_out(*query, i) for query, i in zip(shared.value.queries(batch.column(1)), own, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(votes, pa.float64())], names=["place", "vote"])

    if not len(model.terms):
        return shared, np.zeros(0), np.zeros(0)
    spread = shown.select("id", "text").repartition(64, "id")  # some hundred examples a task
    votes = spread.mapInArrow(leave, "place bigint, vote double").toArrow()
    votes = votes.column("vote").to_numpy()[np.argsort(votes.column("place").to_numpy())]
    return shared, *monotone(votes, model.labels, model.share)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, score, evidence_ids, evidence_cosines, evidence_toxic) of all documents.  docs: (id, text); labels: (id, toxic)."""
    shared, votes, levels = fit(docs, labels)
    kind = docs.schema["id"].dataType.simpleString()
    arrow = pa.schema([("score", pa.float64()), ("cosines", pa.list_(pa.float64())), ("toxic", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple] = {}  # copies are asked once
        for batch in batches:
            for lo, hi in parts(batch.column(1), 2 << 20):
                texts = batch.column(1).slice(lo, hi - lo)
                out = []
                for text, query in zip(texts, shared.value.queries(texts), strict=True):
                    key = hashlib.md5((text.as_py() or "").encode()).digest()
                    if key not in known:
                        if len(known) > 20_000:
                            known.clear()
                        known[key] = shared.value.score(*query, votes, levels)
                    out.append(known[key])
                ids = batch.column(0).slice(lo, hi - lo)
                scores, near, cosines, toxic = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(scores, arrow.field(0).type), pa.array(near, pa.list_(ids.type)), pa.array(cosines, arrow.field(1).type), pa.array(toxic, arrow.field(2).type)],
                    names=["id", "score", "evidence_ids", "evidence_cosines", "evidence_toxic"],
                )

    return docs.mapInArrow(run, f"id {kind}, score double, evidence_ids array<{kind}>, evidence_cosines array<double>, evidence_toxic array<int>")


def held_out(doc_id: str) -> F.Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, learned from labels outside the held-out quarter, with its nearest examples."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out("doc_id")).select(F.col("doc_id").alias("id"), "toxic")
    found = score(docs, labels).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence_ids", "evidence_cosines", "evidence_toxic")
