import bisect
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import sharding as S
from millrace.llm.ranks import coarse, ranked


def one_by_one(sizes, capacity):
    rooms, n, at = [], 0, {}
    for s in sorted((s for s, c in sizes for _ in range(c)), reverse=True):
        i = bisect.bisect_left(rooms, (s, -1))
        if i == len(rooms):
            room, number, n = capacity, n, n + 1
        else:
            room, number = rooms.pop(i)
        at.setdefault(number, []).append(s)
        bisect.insort(rooms, (room - s, number))
    return at


def test_runs_equal_best_fit_one_by_one():
    rng = random.Random(2)
    for _ in range(20):
        sizes = list(Counter(rng.randint(1, 60) for _ in range(200)).items())
        got = defaultdict(list)
        for s, a, b, number in S.pack(sizes, 100):
            got[number] += [s] * (b - a)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in one_by_one(sizes, 100).items()}
    with pytest.raises(ValueError, match="exceeds"):
        S.pack([(101, 1)], 100)


def test_spread():
    rng = random.Random(3)
    for sizes in ([(rng.randint(20, 5000), rng.randint(1, 5)) for _ in range(400)], [(1000, 1), (10, 30)], [(7, 3)], [(100_000, 2), (5, 4000)]):
        sizes = list(Counter({s: n for s, n in sizes}).items())
        runs = S.spread(sizes, 8)
        placed, load = Counter(), Counter()
        for s, a, b, number in runs:
            placed[s] += b - a
            load[number] += s * (b - a)
            assert 0 <= number < 8
        assert placed == Counter(dict(sizes))
        ranks = defaultdict(list)
        for s, a, b, _ in runs:
            ranks[s] += range(a, b)
        assert all(sorted(r) == list(range(placed[s])) for s, r in ranks.items())
        if len(sizes) > 100:
            assert max(load.values()) - min(load.values()) < 0.01 * max(load.values())


def test_query(spark, make, odd, prose, sf_of):
    rng = random.Random(4)
    rows = [*odd, *((i, prose(i, rng.randint(1, 80))) for i in range(600)), *((2000 + i, "the hot text " * 5) for i in range(200))]
    got = S.op2_sharding(spark, sf_of(documents=make(rows))).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t)
    by, slots = defaultdict(set), defaultdict(list)
    for r in got:
        body = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(body) + 16, zlib.crc32(body), "bytes", None)
        by[body].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(x) == 1 for x in by.values()) and set(slots) <= set(range(40))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_capacity_empty_and_clashes(spark, make):
    df = make([(i, "x" * (i * 7 % 50)) for i in range(100)]).selectExpr("*", "1 AS size", "2 AS shard", "3 AS row", "4 AS _key")
    got = S.shard(df, capacity=300).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert max(r.s for r in got) <= 300
    assert S.shard(df.filter("false"), shards=4).count() == 0
    assert S.shard(df, shards=4).select("row.*").columns == df.columns


def test_ranks(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("c"))
    for c, rows in df.toPandas().groupby("c"):
        assert sorted(r.k for r in ranked(df, "c", ["id"], "k").filter(F.col("c") == c).collect()) == list(range(len(rows)))
    sizes = [1, 5, 4095, 16383, 16384, 16385, 99999, 10**9 + 1, 2**40 + 1]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in sizes], "s long").select(coarse(F.col("s"), 14)).collect()]
    assert all(s <= g <= s * (1 + 1 / 8192) + 1 for s, g in zip(sizes, got, strict=True)) and got[:4] == sizes[:4]


def test_repeated_rows_are_dealt_over_parts(spark, make):
    """A row that is repeated exactly doesn't land in one part, and ranks have no gaps."""
    from pyspark.sql import functions as F

    from millrace.llm import ranks
    from millrace.llm.scratch import keep

    rows = keep(ranks.salted(spark.range(4000).select(F.lit(1).alias("cls"), F.lit(7).alias("id"))), "salted")
    got = ranks.ranked(rows, "cls", ["id", "_salt"], "rank").collect()
    assert sorted(r["rank"] for r in got) == list(range(4000))
    assert rows.select(F.pmod(F.xxhash64("id", "_salt"), F.lit(ranks.PARTS)).alias("p")).distinct().count() > ranks.PARTS // 2
