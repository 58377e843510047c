"""Sharding by best-fit-decreasing bin packing of indivisible groups.

A group is the rows of one text.  Its size is its bytes; sizes are rounded up to
14 leading bits, so the driver packs a histogram of bounded length (under
420,000 classes for any 64-bit size) and the bytes of a shard are off by one
part in 8,192 at most.  A run of equal sizes enters the tightest bin as often as
it fits there, which is what best fit does with the items one by one; the open
bins stand in a balanced tree by remaining capacity.

For a given number of shards the capacity is the least of a rising series that
best fit meets.  A group larger than the mean of what is left has a shard alone.

Defined cases: a null text equals the empty one; repeated rows are rows of one
group; an empty table gives an empty table; a hot text's rows are joined to its
group's shard by a join that Spark splits; extra columns travel inside ``row``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.ranks import coarse, ranked, salted
from millrace.llm.scratch import keep

#: Leading bits of a group's size that the packing sees.
BITS = 14
#: Bytes that a row costs besides its text.
OVERHEAD = 16

Run = tuple[int, int, int, int]  # class, first rank, last rank + 1, bin


class _Node:
    __slots__ = ("key", "left", "right", "heap")

    def __init__(self, key: tuple[int, int]):
        self.key, self.left, self.right = key, None, None
        self.heap = hash((key, 0x5BD1E995))


class CapacityTree:
    """Bins by (remaining capacity, number): a treap with hashed priorities."""

    def __init__(self):
        self.root: _Node | None = None

    def _split(self, node: _Node | None, key: tuple[int, int]) -> tuple[_Node | None, _Node | None]:
        if node is None:
            return None, None
        if node.key < key:
            node.right, rest = self._split(node.right, key)
            return node, rest
        rest, node.left = self._split(node.left, key)
        return rest, node

    def _merge(self, a: _Node | None, b: _Node | None) -> _Node | None:
        if a is None or b is None:
            return a or b
        if a.heap > b.heap:
            a.right = self._merge(a.right, b)
            return a
        b.left = self._merge(a, b.left)
        return b

    def insert(self, remaining: int, number: int) -> None:
        left, right = self._split(self.root, (remaining, number))
        self.root = self._merge(self._merge(left, _Node((remaining, number))), right)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the bin with the least room of at least ``size``."""
        node, best = self.root, None
        while node:
            if node.key >= (size, -1):
                best, node = node.key, node.left
            else:
                node = node.right
        if best is None:
            return None
        left, right = self._split(self.root, best)
        _, right = self._split(right, (best[0], best[1] + 1))
        self.root = self._merge(left, right)
        return best


def pack(sizes: list[tuple[int, int]], capacity: int, bins: int | None = None, first: int = 0, start: dict[int, int] | None = None) -> list[Run] | None:
    """Best fit of (size, count) pairs, largest first; None if ``bins`` don't do.

    Without ``bins`` new ones open as they are needed.  ``first`` numbers the
    first bin; ``start`` has ranks of a size that are already placed.
    """
    tree, opened, runs = CapacityTree(), 0, []
    for _ in range(bins or 0):
        tree.insert(capacity, first + opened)
        opened += 1
    for size, count in sorted(sizes, reverse=True):
        at, left = (start or {}).get(size, 0), count
        while left:
            found = tree.take_tightest(size)
            if found is None:
                if bins is not None:
                    return None
                if size > capacity:
                    raise ValueError(f"a group of {size} bytes exceeds the capacity {capacity}")
                found = (capacity, first + opened)
                opened += 1
            room, number = found
            n = min(left, room // size)
            runs.append((size, at, at + n, number))
            at, left = at + n, left - n
            tree.insert(room - n * size, number)
    return runs


def spread(sizes: list[tuple[int, int]], shards: int) -> list[Run]:
    """Near equal bytes in so many shards."""
    left = dict(sizes)
    runs: list[Run] = []
    placed: dict[int, int] = {}
    number, total = 0, sum(s * n for s, n in sizes)
    for size in sorted(left, reverse=True):  # ends at the first that fits: at most ``shards`` turns
        while left.get(size) and number < shards - 1 and size * (shards - number) > total:
            runs.append((size, placed.get(size, 0), placed.get(size, 0) + 1, number))
            placed[size] = placed.get(size, 0) + 1
            left[size] -= 1
            number, total = number + 1, total - size
        if left.get(size):
            break
    rest = [(s, n) for s, n in left.items() if n]
    if not rest:
        return runs
    bins = shards - number
    mean, least = -(-total // bins), max(s for s, _ in rest)
    slack = 0.0
    while True:
        found = pack(rest, max(least, mean + int(mean * slack)), bins, number, placed)
        if found is not None:
            return runs + found
        slack = slack * 2 if slack else 1e-6


def shard(df: DataFrame, text: str = "text", shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """``row``, the input row as a struct, its size, text_crc32 and shard.

    Give ``shards`` for near equal bytes in so many, or ``capacity`` for as few
    shards of at most so many bytes as best fit needs.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    spark = df.sparkSession
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(
        F.struct("*").alias("row"), (F.octet_length(body) + OVERHEAD).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("_key")
    )
    groups = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.max("size").alias("_size"))
    groups = keep(groups.select("_key", coarse(F.col("_n") * F.col("_size"), BITS).alias("_class")), "shard-groups")
    sizes = [(r[0], r[1]) for r in groups.groupBy("_class").count().collect()]  # of bounded length, see above
    runs = (spread(sizes, shards) if shards is not None else pack(sizes, capacity)) if sizes else []
    table = spark.createDataFrame(runs, "_size bigint, _from bigint, _to bigint, shard int")
    placed = ranked(groups, "_class", ["_key"], "_rank").join(
        F.broadcast(table),  # a row for each run: bounded as the histogram is
        (F.col("_class") == F.col("_size")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
    )
    placed = keep(placed.select(F.col("_key").alias("_group"), "shard"), "shard-placed")
    return rows.join(placed, F.col("_key") == F.col("_group")).select("row", "size", "text_crc32", "shard")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 shards of near equal bytes; equal texts stay together."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    small = shard(docs, shards=40).select("row.doc_id", "size", "text_crc32", "shard")
    placed = ranked(keep(salted(small), "shard-rows"), "shard", ["doc_id", "text_crc32", "size", "_salt"], "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
