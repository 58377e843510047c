"""Best-fit packing of token sequences by the linear grouping scheme.

Only the histogram of piece lengths, one entry for each length up to the
capacity, reaches the driver.  There

1. large lengths are cut, in falling order, into groups of equal cardinality and
   rounded up to the largest of their group;
2. the cutting-stock program over these few sizes is solved by column
   generation: a revised simplex with a knapsack for the next configuration;
3. each configuration, taken its rounded-down number of times, is filled whole
   with actual pieces: a member of a size by the longest piece within that size,
   the last member by the longest within the room that is left, which rounding
   makes at least its size;
4. what large pieces are left are grouped and solved again, as long as a
   configuration is used;
5. the rest goes, longest first, where it fits best, and new sequences open only
   for what fits nowhere.

How much of the capacity makes a length large decides what steps 1 to 4 see.  The
plan is made for each share of ``LARGE`` and the one of fewest sequences is taken,
the first of equal ones; at 1 no length is large and step 5 does all.

Placements are runs, "ranks a to b of length L go to sequences from s, k each",
so their number doesn't grow with the pieces.  Executors rank the pieces of a
length, look the run up and sum offsets within a sequence.

Ids come from a ``tokenizers`` file.  Where it is a byte-level model with the usual
pattern, texts of Latin letters are cut by that pattern here, and the file's model
encodes each distinct part once; all others go to its tokenizer whole.

Defined cases: a null text is empty and gives the end id alone; a long text is
cut, its first piece the short one; repeated rows are packed once each; an empty
table gives an empty one; extra columns are left out of the pieces, which carry
the id column given.
"""

from __future__ import annotations

import bisect
import itertools
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.ranks import ranked, salted
from millrace.llm.scratch import keep

CAPACITY = 2048
#: Groups of large lengths.
GROUPS = 64
#: Lengths over a share of the capacity are large: the shares that are tried.
LARGE = (1 / 3, 1 / 8, 1)
#: Parts of texts whose ids a worker remembers, and the longest part among them.
REMEMBERED, SHORT = 400_000, 64
END = 0

Run = tuple[int, int, int, int, int]  # length, first rank, last rank + 1, first sequence, pieces a sequence


# The pattern of byte-level vocabularies, its classes spelled out for texts up to U+02AF, and texts beyond.
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ʯ", "0-9²³¹¼-¾", " \t\n\r\x0b\x0c"
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_BEYOND = re.compile(r"[^\t-\r -~¡-ʯ]")
#: A byte's letter in such a vocabulary: itself if it is printable, else the next one from U+0100.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {b: b for b in _PLAIN} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}


class _Remembered(dict):
    """Ids by part of a text.  Beyond ``REMEMBERED`` parts those not used again are let go."""

    def __init__(self, encode: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, part: str) -> tuple[int, ...]:
        if len(part) > SHORT:
            return self.encode(part)
        ids = self.old.get(part)
        if ids is None:
            ids = self.encode(part)
        if len(self) >= REMEMBERED // 2:
            self.old = dict(self)
            self.clear()
        self[part] = ids
        return ids


@lru_cache(2)
def encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """text -> ids.  ``vocabulary``: the name of a ``tokenizers`` file."""
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    whole = lambda text: own.encode(text, add_special_tokens=False).ids
    told = json.loads(own.to_str())
    cut = told["pre_tokenizer"] or {}
    if told["normalizer"] or told["model"]["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex"):
        return whole
    special = [t.content for t in own.get_added_tokens_decoder().values()]
    known = _Remembered(lambda part: tuple(t.id for t in own.model.tokenize(part.encode().decode("latin-1").translate(_LETTERS))))

    def encode(text: str) -> list[int]:
        if _BEYOND.search(text) or any(s in text for s in special):
            return whole(text)
        return list(itertools.chain.from_iterable(map(known.__getitem__, _PARTS.findall(text))))

    return encode


def pieces(df: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's token pieces."""
    kind = df.schema[doc_id].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            owner, rows = [], []
            for i, body in enumerate(batch.column(1)):
                ids = np.append(np.asarray(encode(body.as_py() or ""), "<u4"), np.uint32(END))
                first = (len(ids) - 1) % capacity + 1
                for k, lo in enumerate([0, *range(first, len(ids), capacity)]):
                    part = ids[lo : lo + (capacity if k else first)]
                    owner.append(i)
                    rows.append((k, lo, len(part), zlib.crc32(part.tobytes())))
            table = list(zip(*rows, strict=True)) or [[], [], [], []]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *(pa.array(x, t) for x, t in zip(table, kinds, strict=True))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    small = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return small.mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def _knapsack(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable multiset of sizes within the capacity, by numbers of members."""
    room = np.arange(capacity + 1) - sizes[:, None]
    fits, room = room >= 0, np.maximum(room, 0)
    best, levels = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        gain = np.where(fits, best[room] + worth[:, None], -1.0)
        which = gain.argmax(axis=0)
        top = gain[which, np.arange(capacity + 1)]
        which[top <= best + 1e-12] = -1
        if (which < 0).all():
            break
        best = np.maximum(best, top)
        levels.append(which)
    taken, left = np.zeros(len(sizes)), capacity
    for which in reversed(levels):
        if which[left] >= 0:
            taken[which[left]] += 1
            left -= int(sizes[which[left]])
    return taken


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each, rounded down from the optimum."""
    k, wide = len(sizes), np.array(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    for _ in range(60 * k):
        inverse = np.linalg.inv(basis)
        worth = np.ones(k) @ inverse
        column = _knapsack(wide, np.maximum(worth, 0), capacity)
        if worth @ column <= 1 + 1e-7:
            break
        change, level = inverse @ column, inverse @ need
        ratio = np.where(change > 1e-9, level / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    level = np.linalg.inv(basis) @ need
    return [(basis[:, j].astype(int), int(n)) for j in range(k) if (n := np.floor(level[j] + 1e-6)) >= 1]


class _Gaps:
    """Runs of sequences by the room that is left in each."""

    def __init__(self):
        self.rooms: dict[int, list[tuple[int, int]]] = {}
        self.order: list[int] = []

    def add(self, room: int, first: int, count: int) -> None:
        if count <= 0 or room <= 0:
            return
        if room not in self.rooms:
            self.rooms[room] = []
            bisect.insort(self.order, room)
        self.rooms[room].append((first, count))

    def tightest(self, length: int) -> tuple[int, int, int] | None:
        i = bisect.bisect_left(self.order, length)
        if i == len(self.order):
            return None
        room = self.order[i]
        first, count = self.rooms[room].pop()
        if not self.rooms[room]:
            del self.rooms[room]
            del self.order[i]
        return room, first, count


class _Stock:
    """The pieces that are left, by length."""

    def __init__(self, histogram: dict[int, int]):
        self.left = {x: (0, n) for x, n in histogram.items() if n}  # next rank, count
        self.order = sorted(self.left)

    def take(self, longest: int, n: int) -> tuple[int, int, int] | None:
        """(length, first rank, count) of at most ``n`` pieces of the longest length within ``longest``."""
        i = bisect.bisect_right(self.order, longest)
        if not i:
            return None
        length = self.order[i - 1]
        rank, count = self.left[length]
        if count <= n:
            del self.left[length], self.order[i - 1]
        else:
            self.left[length] = (rank + n, count - n)
        return length, rank, min(n, count)

    def between(self, low: float, high: int) -> list[tuple[int, int]]:
        """(length, count), longest first."""
        return [(x, self.left[x][1]) for x in reversed(self.order) if low < x < high]


def grouped(lengths: list[tuple[int, int]], groups: int) -> tuple[list[int], list[int]]:
    """Sizes and demands of groups of equal cardinality, each of its longest length."""
    per = -(-sum(n for _, n in lengths) // groups)
    demand: dict[int, int] = {}
    room = size = 0
    for length, left in lengths:
        while left:
            if not room:
                size, room = length, per
            n = min(left, room)
            demand[size] = demand.get(size, 0) + n
            left, room = left - n, room - n
    return list(demand), list(demand.values())


def _fill(stock: _Stock, members: list[int], times: int, capacity: int, first: int, runs: list[Run], gaps: _Gaps) -> int:
    """A configuration's members, longest first, in sequences from ``first``: how many it opened."""
    parts = [(0, times, capacity)]  # sequences from, to, and the room in each
    for k, size in enumerate(members):
        filled = []
        for lo, hi, room in parts:
            while lo < hi:
                got = stock.take(room if 0 < k == len(members) - 1 else size, hi - lo)
                if got is None:
                    filled += [(lo, hi, room)] if k else []
                    break
                length, rank, n = got
                runs.append((length, rank, rank + n, first + lo, 1))
                filled.append((lo, lo + n, room - length))
                lo += n
        parts = filled
    for lo, hi, room in parts:
        gaps.add(room, first + lo, hi - lo)
    return max((hi for _, hi, _ in parts), default=0)


def _planned(histogram: dict[int, int], capacity: int, groups: int, large: float) -> tuple[list[Run], int]:
    runs: list[Run] = []
    stock, gaps, total = _Stock(histogram), _Gaps(), histogram.get(capacity, 0)
    if total:
        runs.append((*stock.take(capacity, total)[:2], total, 0, 1))
    used = True
    while used and (some := stock.between(capacity * large, capacity)):
        used, sizes = 0, []
        sizes, demand = grouped(some, groups)
        for config, times in sorted(configurations(sizes, demand, capacity), key=lambda x: (-x[0]).tolist()):
            members = [s for s, n in zip(sizes, config.tolist(), strict=True) for _ in range(n)]
            opened = _fill(stock, members, times, capacity, total, runs, gaps)
            total, used = total + opened, used + opened
    for length, (rank, left) in sorted(stock.left.items(), reverse=True):
        while left:
            found = gaps.tightest(length)
            if found is None:
                k = capacity // length
                found = (capacity, total, -(-left // k))
                total += found[2]
            space, first, count = found
            k = space // length
            full = min(count, left // k)
            if full:
                runs.append((length, rank, rank + full * k, first, k))
                gaps.add(space - k * length, first, full)
                rank, left, first, count = rank + full * k, left - full * k, first + full, count - full
            if count and left and left < k:
                runs.append((length, rank, rank + left, first, left))
                gaps.add(space - left * length, first, 1)
                left, first, count = 0, first + 1, count - 1
            gaps.add(space, first, count)
    return runs, total


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: tuple[float, ...] = LARGE) -> tuple[list[Run], int]:
    """Runs that place every piece, and the number of sequences."""
    least = -(-sum(x * n for x, n in histogram.items()) // capacity)
    best: tuple[list[Run], int] | None = None
    for share in large:
        found = _planned(histogram, capacity, groups, share)
        if best is None or found[1] < best[1]:
            best = found
        if best[1] == least:
            break
    return best


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset.  ``cut``: a written table of salted pieces."""
    spark = cut.sparkSession
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    runs, _ = plan(histogram, capacity)
    table = spark.createDataFrame(runs, "_length bigint, _from bigint, _to bigint, _first bigint, _each bigint")
    placed = ranked(cut, "length", ["doc_id", "piece", "ids_crc32", "_salt"], "_rank").join(
        F.broadcast(table),  # bounded by lengths and configurations, not by pieces
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
    )
    placed = placed.withColumn("sequence_id", (F.col("_first") + F.floor((F.col("_rank") - F.col("_from")) / F.col("_each"))).cast("long"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", offset.alias("offset"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the packed pieces of all documents."""
    return pack(keep(salted(pieces(docs, "byte_bpe_50k.json")), "pieces"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 tokens."""
    return pack_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
