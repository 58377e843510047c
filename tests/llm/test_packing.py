import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import packing as P


def check(histogram, capacity=2048):
    runs, total = P.plan(histogram, capacity)
    placed, load = defaultdict(list), Counter()
    for length, a, b, first, each in runs:
        placed[length] += range(a, b)
        for r in range(a, b):
            load[first + (r - a) // each] += length
    assert all(sorted(placed[x]) == list(range(n)) for x, n in histogram.items())
    assert max(load.values(), default=0) <= capacity and all(0 <= s < total for s in load)
    assert len(load) == total
    return total


def test_plans_are_whole_and_tight():
    rng = random.Random(1)
    for n in (0, 1, 5, 300, 5000):
        histogram = Counter(min(2048, int(rng.expovariate(1 / 500)) + 1) for _ in range(n))
        total = check(dict(histogram))
        least = -(-sum(k * v for k, v in histogram.items()) // 2048)
        assert total <= max(least + 2, least * 1.02)
    assert check({2048: 3, 1025: 4, 1023: 4}) == 7
    assert check({1: 5000}) == 3
    assert check({1365: 30, 683: 30}) <= 31


def optimum(lengths, capacity):
    """The least number of sequences, by all ways."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def test_small_cases_against_the_optimum():
    rng = random.Random(4)
    for _ in range(40):
        lengths = sorted((rng.randint(1, 100) for _ in range(rng.randint(1, 9))), reverse=True)
        assert check(dict(Counter(lengths)), 100) <= optimum(lengths, 100) + 1


def test_configurations_decide():
    """Halves, quarters and a bit: best fit alone pairs the wrong ones."""
    histogram = {1028: 600, 520: 600, 516: 600, 504: 1200}
    rng = random.Random(5)
    mixed = Counter(rng.randint(300, 1100) for _ in range(3000))
    for h, most in ((histogram, 0.85), (mixed, 0.995)):
        assert check(h) <= most * P.plan(h, large=(1,))[1]
        assert P.plan(h, large=(1 / 8,))[1] <= most * P.plan(h, large=(1,))[1]


def test_configurations_fill_the_capacity():
    sizes, demand = [60, 45, 35, 20], [10, 20, 30, 40]
    for config, times in P.configurations(sizes, demand, 100):
        assert times >= 1 and config @ sizes <= 100
    made = sum(c * n for c, n in P.configurations(sizes, demand, 100))
    assert all(made <= demand) and sum(n for _, n in P.configurations(sizes, demand, 100)) <= 41
    assert P.grouped([(9, 5), (8, 1), (4, 2)], 4) == ([9, 8, 4], [6, 1, 1]) or sum(P.grouped([(9, 5), (8, 1), (4, 2)], 4)[1]) == 8


def test_ids_equal_the_file(prose):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = P.encoder("byte_bpe_50k.json")
    rng = random.Random(6)
    letters = [chr(i) for i in [*range(1, 0x300), 0x4E2D, 0x1F600, 0x2028, 0x3000]] + [" "] * 200 + list("abc'st'll\n\t 12") * 20
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += ["".join(rng.choice([" ", " ", "\n", "\t", "a", "é", "'ll", "9", "!", "\x0b"]) for _ in range(30)) for _ in range(400)]
    texts += [prose(1, 500), "a" * 5000, " " * 5001 + "x", "it's we'll <|endoftext|> x"]
    for t in texts:
        assert list(encode(t)) == own.encode(t, add_special_tokens=False).ids, repr(t)


def test_long_white_space_and_memory(monkeypatch):
    encode = P.encoder("byte_bpe_50k.json")
    assert len(encode(" " * 10_000_000 + "x")) > 1000
    monkeypatch.setattr(P, "REMEMBERED", 10)
    known = P._Remembered(lambda x: (len(x),))
    for i in range(100):
        assert known[f"{i}"] == (len(str(i)),) and len(known) + len(known.old) <= 10


def test_query(spark, make, odd, prose, sf_of):
    rng = random.Random(2)
    rows = [*odd, (1, "ends <|endoftext|> here"), (2, prose(9, 9000)), *((10 + i, prose(i, rng.randint(1, 900))) for i in range(150))]
    got = P.op7_best_fit_packing(spark, sf_of(documents=make(rows))).collect()
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in rows:
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = (len(ids) - 1) % 2048 + 1
        for k, (lo, hi) in enumerate([(0, first), *((x, x + 2048) for x in range(first, len(ids), 2048))]):
            want[i, k, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(x for _, x in places[:i]) for i in range(len(places))] and sum(x for _, x in places) <= 2048
    least = -(-sum(r.length for r in got) // 2048)
    assert len(sequences) <= least * 1.05 + 1


def test_empty(spark, make):
    assert P.pack_documents(spark, make([(1, "a")]).filter("false"), "").count() == 0
    clash = make([(1, "a"), (None, "b"), (1, "a")]).selectExpr("*", "1 AS piece", "2 AS length", "3 AS sequence_id")
    assert P.pack_documents(spark, clash, "").count() == 3
