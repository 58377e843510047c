"""Masked pseudo-likelihood with a bidirectional window network in numpy.

Tokens are words, A-Z folded.  A word is a symbol, which the network predicts, and
its place among the symbol's words.  The most frequent words of the corpus are
symbols of their own; the rest are classed by their length and last letter.  The
network sees two words on either side, never the one it predicts: the sum of an
embedding for each place (of the symbol next to it, of a coarser class beyond),
tanh, softmax over the symbols.  Within a symbol a word has its share of the
occurrences, counted over all documents.  A document's score is the sum of the
logarithms of both for all its words, each given its neighbours.

Training data are the windows of all positions of all documents, counted: equal
windows are one row with a number, so what is learned from is the whole corpus,
whatever its partitions and however often a text stands in it.  The rows are dealt
by a hash of their context into groups.  In each of some rounds every group starts
from the same weights and takes steps over its contexts, a context's targets
weighted by their numbers; the groups' weights are averaged by theirs, in levels of
bounded fan-in, so only the last, bounded level reaches the driver.

The counts of the ``KNOWN`` most frequent words, about, are broadcast; those of
all others are joined, so every word that the corpus has is scored by its own.

Defined cases: null and empty texts have no tokens, a sum of 0 and a null mean;
beyond a text's ends stands a padding symbol; words of equal count enter the
vocabulary by hash; a word that the corpus doesn't have counts as one that it has
once; repeated rows are scored alike; an empty table gives an empty one; extra
columns travel inside ``row``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.ranks import coarse
from millrace.llm.scratch import keep
from millrace.llm.words import ALNUM, Words, lex, parts, raw

#: Frequent words, each a symbol; lengths and last letters that class the rest.
FREQUENT, LENGTHS, LETTERS = 415, 8, 12
CLASSES = LENGTHS * LETTERS
#: Classes of the words that stand two places away; 0 is beyond the text.
OUTER = 8
HIDDEN = 32
#: Words whose counts are broadcast, at most: 3 MB.  All others' are joined.
KNOWN = 1 << 18
#: Windows of a group, about; rounds of averaging; contexts of a step, and its length.
GROUP, ROUNDS, BATCH, STEP = 1 << 18, 4, 256, 0.1
#: Weights that are averaged in one task.
FAN_IN = 32
_BLOCK = 2048
#: Windows that a task holds before it passes them on.
_HELD = 1 << 20


@dataclass
class Symbols:
    """Symbols of the words of some texts, with padding between texts.

    ``slot`` is a word's place in ``inner`` and ``outer``.
    """

    words: Words
    cls: np.ndarray
    slot: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    size: int

    def contexts(self) -> np.ndarray:
        """A number for each word's neighbours."""
        inner, outer, s = self.inner, self.outer, self.slot
        return ((inner[s - 1] * self.size + inner[s + 1]) * OUTER + outer[s - 2]) * OUTER + outer[s + 2]

    def targets(self) -> np.ndarray:
        return self.inner[self.slot]


def classed(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """The words of texts and the class of each by its length and last letter."""
    words = lex(ALNUM, texts)
    data, at = raw(texts)
    last = data[at[words.row] + words.end - 1].astype(np.int64) if len(words.row) else np.zeros(0, np.int64)
    last = np.where((last >= 65) & (last <= 90), last + 32, last)
    return words, np.minimum((words.end - words.start - 1) // 2, LENGTHS - 1) * LETTERS + last % LETTERS


class Network:
    """Weights of the window network and its passes over contexts."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = np.sort(frequent)
        self.size = 1 + len(self.frequent) + CLASSES
        rng = np.random.Generator(np.random.PCG64(7))
        self.near = (rng.standard_normal((2, self.size, HIDDEN)) * 0.1).astype(np.float32)
        self.far = (rng.standard_normal((2, OUTER, HIDDEN)) * 0.1).astype(np.float32)
        self.out = (rng.standard_normal((HIDDEN, self.size)) * 0.1).astype(np.float32)
        self.bias = np.zeros(self.size, np.float32)

    def weights(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.near, self.far, self.out, self.bias)])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for name in ("near", "far", "out", "bias"):
            old = getattr(self, name)
            setattr(self, name, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def read(self, texts: pa.Array) -> Symbols:
        words, cls = classed(texts)
        length = words.end - words.start
        inner, outer = 1 + len(self.frequent) + cls, 4 + np.minimum((length - 1) // 4, 3)
        if len(self.frequent) and len(inner):
            at = np.minimum(np.searchsorted(self.frequent, words.hash), len(self.frequent) - 1)
            known = self.frequent[at] == words.hash
            inner[known] = 1 + at[known]
            outer[known] = 1 + np.minimum(length[known] // 2, 2)
        slot = np.arange(len(inner)) + 2 * (words.row + 1)
        padded = np.zeros((2, len(inner) + 2 * (words.rows + 1)), np.int64)
        padded[0, slot], padded[1, slot] = inner, outer
        return Symbols(words, cls, slot, padded[0], padded[1], self.size)

    def places(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Left and right neighbours, and the classes beyond them."""
        inner = context // (OUTER * OUTER)
        return inner // self.size, inner % self.size, context // OUTER % OUTER, context % OUTER

    def hidden(self, places: tuple[np.ndarray, ...]) -> np.ndarray:
        total = self.near[0][places[0]]
        total += self.near[1][places[1]]
        total += self.far[0][places[2]]
        total += self.far[1][places[3]]
        return np.tanh(total, out=total)

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target, given its context; equal contexts are passed once."""
        order = np.argsort(context, kind="stable")
        ordered = context[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = ordered[1:] != ordered[:-1]
        starts = np.append(np.flatnonzero(fresh), len(order))
        which = np.cumsum(fresh) - 1
        out = np.empty(len(order))
        for i in range(0, len(starts) - 1, _BLOCK):
            lo, hi = starts[i], starts[min(i + _BLOCK, len(starts) - 1)]
            logits = self.hidden(self.places(ordered[starts[i : min(i + _BLOCK, len(starts) - 1)]])) @ self.out
            logits += self.bias
            own = logits[which[lo:hi] - i, target[order[lo:hi]]]
            np.exp(logits, out=logits)  # weights stay small, see learn
            out[order[lo:hi]] = own - np.log(logits.sum(axis=1))[which[lo:hi] - i]
        return out

    def gradient(self, places: tuple[np.ndarray, ...], row: np.ndarray, target: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the mean of -log p over weighted targets: by out, by bias, and by the sum of embeddings of each context."""
        hidden = self.hidden(places)
        error = hidden @ self.out
        error += self.bias
        error -= error.max(axis=1, keepdims=True)
        np.exp(error, out=error)
        total = np.bincount(row, n, len(hidden)).astype(np.float32)
        error *= (total / error.sum(axis=1))[:, None]
        error[row, target] -= n
        error /= total.sum()
        return hidden.T @ error, error.sum(axis=0), (error @ self.out.T) * (1 - hidden * hidden)

    def learn(self, context: np.ndarray, row: np.ndarray, target: np.ndarray, n: np.ndarray) -> None:
        """Adagrad steps over contexts; (row, target, n): their targets, by rising row."""
        memory = [np.zeros_like(x) for x in (self.out, self.bias, self.near, self.far)]
        for i in range(0, len(context), BATCH):
            lo, hi = np.searchsorted(row, [i, i + BATCH])
            places = self.places(context[i : i + BATCH])
            by_out, by_bias, back = self.gradient(places, row[lo:hi] - i, target[lo:hi], n[lo:hi])
            for weight, change, seen in ((self.out, by_out, memory[0]), (self.bias, by_bias, memory[1])):
                seen += change * change
                weight -= STEP * change / np.sqrt(seen + 1e-8)
                np.clip(weight, -2, 2, out=weight)
            for k, place in enumerate(places):
                table, seen = (self.near[k], memory[2][k]) if k < 2 else (self.far[k - 2], memory[3][k - 2])
                tokens, inverse = np.unique(place, return_inverse=True)
                pick = np.zeros((len(tokens), len(place)), np.float32)
                pick[inverse, np.arange(len(place))] = 1
                change = pick @ back
                seen[tokens] += change * change
                table[tokens] -= STEP * change / np.sqrt(seen[tokens] + 1e-8)


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, with the sums of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, cls = classed(batch.column(0))
        h, at, n = np.unique(words.hash, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(cls[at].astype(np.int32)), pa.array(n)], names=["h", "c", "n"])


def _windows(network: Network):
    """Texts -> window number and how often it stands there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return summed(*(np.concatenate(x) for x in zip(*held, strict=True)))

        for batch in batches:
            for lo, hi in parts(batch.column(0)):
                found = network.read(batch.column(0).slice(lo, hi - lo))
                windows, n = np.unique(found.contexts() * network.size + found.targets(), return_counts=True)
                held.append((windows, n.astype(np.int32)))
                if sum(len(x) for x, _ in held) > 2 * _HELD:
                    held = [merged()]
                    if len(held[0][0]) > _HELD:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in held.pop()], names=["w", "n"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in merged()], names=["w", "n"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition of windows as one row, in an order that doesn't depend on how they came."""
    from pyspark import TaskContext

    some = [b for b in batches if len(b)]
    if some:
        w, n = (np.concatenate([b.column(i).to_numpy() for b in some]) for i in (0, 1))
        order = np.argsort(w)
        group = pa.array([TaskContext.get().partitionId()], pa.int64())
        yield pa.RecordBatch.from_arrays([group, pa.array([w[order].astype("<i8").tobytes()], pa.binary()), pa.array([n[order].astype("<i8").tobytes()], pa.binary())], names=["part", "w", "n"])


def _average(weights: DataFrame) -> np.ndarray | None:
    """Mean of weight vectors by their numbers of windows, in levels."""

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        total = sum(np.frombuffer(w, "<f4").astype(np.float64) * n for w, n in zip(rows.weights, rows.n, strict=True))
        n = int(rows.n.sum())
        return pd.DataFrame({"part": [int(rows.part.iloc[0]) // FAN_IN], "n": [n], "weights": [(total / max(n, 1)).astype("<f4").tobytes()]})

    level = keep(weights.filter("n > 0"), "weights")
    while level.count() > FAN_IN:
        level = keep(level.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(fold, level.schema), "weights")
    rows = level.toPandas()  # at most FAN_IN vectors of fixed length
    return np.frombuffer(fold(rows).weights[0], "<f4") if len(rows) else None


@dataclass
class Model:
    """The network with the words' counts: broadcast ones, each class's sum, and the table of all."""

    network: Network
    known: np.ndarray
    log_count: np.ndarray
    log_class: np.ndarray
    counts: DataFrame
    least: int

    def shared(self) -> tuple[Network, np.ndarray, np.ndarray, np.ndarray]:
        """What executors need."""
        return self.network, self.known, self.log_count, self.log_class


def _least(counts: DataFrame) -> int:
    """The lowest count that ``KNOWN`` words at most reach, to six leading bits."""
    sizes = counts.groupBy(coarse(F.col("n"), 6).alias("n")).agg(F.count(F.lit(1)).alias("words")).collect()  # under 4,000 rows
    total, least = 0, 1 << 62
    for n, words in sorted(((r.n, r.words) for r in sizes), reverse=True):
        total += words
        if total > KNOWN:
            break
        least = n
    return least


def trained(network: Network, texts: DataFrame) -> Network:
    """The network learned from the windows of all texts."""
    counted = texts.mapInArrow(_windows(network), "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n"))
    windows = keep(counted, "windows")
    groups = max(1, -(-windows.count() // GROUP))
    dealt = windows.repartition(groups, F.floor(F.col("w") / network.size))
    packed = keep(dealt.mapInArrow(_packed, "part bigint, w binary, n binary"), "groups")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Network(network.frequent)
        for batch in batches:
            for part, w, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                w, n = np.frombuffer(w, "<i8"), np.frombuffer(n, "<i8")
                context, row = np.unique(w // here.size, return_inverse=True)
                mixed = np.random.Generator(np.random.PCG64(part)).permutation(len(context))  # a step sees contexts of all kinds
                row = mixed[row]
                order = np.argsort(row, kind="stable")
                spread = np.empty_like(context)
                spread[mixed] = context
                here.load(start)
                here.learn(spread, row[order], (w % here.size)[order], n[order].astype(np.float32))
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([int(n.sum())]), pa.array([here.weights().astype("<f4").tobytes()], pa.binary())], names=["part", "n", "weights"])

    start = network.weights()
    for _ in range(ROUNDS):
        found = _average(packed.mapInArrow(learn, "part bigint, n bigint, weights binary"))
        if found is None:
            break
        start = found
    network.load(start)
    return network


def train(texts: DataFrame) -> Model:
    """A model of all documents of a one-column table."""
    counts = keep(texts.mapInArrow(_counted, "h bigint, c int, n bigint").groupBy("h").agg(F.min("c").alias("c"), F.sum("n").alias("n")), "words")
    top = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).collect()
    sums = np.ones(CLASSES)
    for c, n in counts.groupBy("c").agg(F.sum("n")).collect():  # CLASSES rows
        sums[c] += n
    for r in top:
        sums[r.c] -= r.n
    least = _least(counts)
    rows = counts.filter(F.col("n") > least - 1).select("h", "n").toArrow()  # at most KNOWN rows
    h, n = rows.column("h").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    order = np.argsort(h)
    network = trained(Network(np.array([r.h for r in top], np.int64).view(np.uint64)), texts)
    return Model(network, h[order], np.log(n[order]).astype(np.float32), np.log(np.maximum(sums, 1)), counts, least)


def _scored(shared):
    """(row, text) -> row, a key of the text, its tokens, the sum of what is known here, and the words to look up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, known, log_count, log_class = shared.value
        for batch in batches:
            for lo, hi in parts(batch.column(1), 4 << 20):
                texts = batch.column(1).slice(lo, hi - lo)
                rows = hi - lo
                found = network.read(texts)
                words, target = found.words, found.targets()
                value = network.log_probabilities(found.contexts(), target)
                rare = target > len(network.frequent)
                value[rare] -= log_class[found.cls[rare]]
                other = np.flatnonzero(rare)
                at = np.minimum(np.searchsorted(known, words.hash[other]), max(0, len(known) - 1))
                here = known[at] == words.hash[other] if len(known) else np.zeros(len(other), bool)
                value[other[here]] += log_count[at[here]]
                ask = other[~here]
                ask = ask[np.lexsort((words.hash[ask], words.row[ask]))]
                fresh = np.ones(len(ask), bool)
                fresh[1:] = (words.hash[ask][1:] != words.hash[ask][:-1]) | (words.row[ask][1:] != words.row[ask][:-1])
                times = np.diff(np.append(np.flatnonzero(fresh), len(ask)))
                ask = ask[fresh]
                total = np.bincount(words.row, value, rows).astype(np.float64)  # without tokens numpy gives integers
                offsets = np.searchsorted(words.row[ask], np.arange(rows + 1)).astype(np.int32)
                asked = pa.StructArray.from_arrays([pa.array(words.hash[ask].view(np.int64)), pa.array(times, pa.int32())], names=["h", "k"])
                keys = [hashlib.blake2b((t.as_py() or "").encode(), digest_size=16).digest() for t in texts]
                n = np.bincount(words.row, minlength=rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, rows), pa.array(keys, pa.binary()), pa.array(n, pa.int64()), pa.array(total), pa.ListArray.from_arrays(pa.array(offsets), asked)],
                    names=["row", "key", "n_tokens", "part", "ask"],
                )

    return run


def score(df: DataFrame, text: str = "text", model: Model | None = None, carry: list[str] | None = None) -> DataFrame:
    """``row``, the input row (or its ``carry`` columns) as a struct, n_tokens, log_prob and mean_log_prob."""
    model = model or train(df.select(F.col(f"`{text}`").alias("text")))
    shared = df.sparkSession.sparkContext.broadcast(model.shared())  # of bounded size, see KNOWN
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in (df.columns if carry is None else carry))).alias("row"), F.col(f"`{text}`").alias("text"))
    fields = T._parse_datatype_string("key binary, n_tokens bigint, part double, ask array<struct<h:bigint,k:int>>").fields
    found = keep(rows.mapInArrow(_scored(shared), T.StructType([rows.schema["row"], *fields])), "scored")
    # a word of a text once, however many rows have the text; merge joins at every size
    asked = found.select("key", F.inline("ask")).groupBy("key", "h").agg(F.max("k").alias("k"))
    rest = model.counts.filter(F.col("n") < model.least).select(F.col("h").alias("_h"), "n")
    told = asked.join(rest.hint("merge"), F.col("h") == F.col("_h"), "left").groupBy(F.col("key").alias("_key")).agg(F.sum(F.col("k") * F.log(F.coalesce("n", F.lit(1)))).alias("_rest"))
    out = found.join(told.hint("merge"), F.col("key") == F.col("_key"), "left").withColumn("log_prob", F.col("part") + F.coalesce("_rest", F.lit(0.0)))
    return out.select("row", "n_tokens", "log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).alias("mean_log_prob"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pseudo-log-likelihood of every document under a network learned from all."""
    found = score(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), carry=["doc_id"])
    return found.select("row.doc_id", "n_tokens", "log_prob", "mean_log_prob")
