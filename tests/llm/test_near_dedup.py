import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import near_dedup as N
from millrace.llm.components import components
from millrace.llm.words import ALNUM, lex, shingles


def bag(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similar(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def edited(text, seed, n):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def test_weighted_jaccard_and_collisions(prose):
    base = prose(1, 200)
    a = [base, base, "a b c d e f a b c d e f", "one", "", base]
    b = [edited(base, 1, 3), prose(2, 200), "a b c d e f", "one", "", base + " " + base]
    want = [similar(bag(x), bag(y)) for x, y in zip(a, b, strict=True)]
    assert np.allclose(N.weighted_jaccard(pa.array(a), pa.array(b), 5), want)

    def sketch(texts):
        row, strip = N.strips(*shingles(lex(ALNUM, pa.array(texts)), 5))
        return N.signatures(row, strip, len(texts), 2000)

    agree = (sketch(a) == sketch(b)).mean(axis=1)
    for got, w, x in zip(agree, want, a, strict=True):
        assert x == "" or abs(got - w) < 0.05
    assert not (sketch([base]) == 0).any()


def classes_of(rows):
    bags, parent = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or similar(bags[i], bags[j]) >= 0.8:
                parent[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), k), k)
    return Counter((k, low[find(i)]) for i, (k, _) in enumerate(rows))


def test_classes_equal_brute_force(spark, make, prose, odd, sf_of):
    rows = [*odd]
    for g in range(12):
        base = prose(100 + g, 120 + 20 * g)
        rows += [(1000 * g + i, edited(base, i, i % 4)) for i in range(8)]
    rows += [(50_000 + i, prose(7, 60)) for i in range(30)]
    got = N.op9_minhash_dedup(spark, sf_of(documents=make(rows))).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == classes_of(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_texts_beside_a_dissimilar_centre(spark, make, prose, monkeypatch):
    base, other = prose(1, 100).split(), prose(2, 60).split()
    c, t = " ".join(base), " ".join([*base[:84], *other[:16]])
    u, w = " ".join([*t.split()[:96], *other[20:24]]), " ".join([*base[8:], *other[30:38]])
    rows = [(1, c), *((10 + i, " ".join([*base[:80], *prose(50 + i, 20).split()])) for i in range(9)), (30, t), (31, u), (40, w)]
    assert similar(bag(c), bag(t)) < 0.8 and similar(bag(c), bag(u)) < 0.8 <= similar(bag(t), bag(u))
    # every text is in one bucket, so that bands don't matter
    monkeypatch.setattr(N, "_banded", lambda signature, bands, each: np.ones((len(signature), 1), np.uint64))
    got = N.classes(make(rows), bands=1, each=1).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == classes_of(rows)
    assert {r.class_id for r in got if r.doc_id in (30, 31)} == {30}


def test_stage_keeps_one_of_each(spark, make, prose, odd):
    rows = [*odd, (1, prose(1, 90)), (2, prose(1, 90)), (3, edited(prose(1, 90), 1, 1)), (4, prose(2, 90)), (None, prose(3, 80))]
    clash = make(rows).selectExpr("*", "1 AS id", "2 AS rep", "3 AS class_id", "4 AS band", "5 AS _kept")
    out = N.keep_one(spark, clash, "")
    assert out.columns == clash.columns
    kept = Counter(r.doc_id for r in out.collect())
    assert kept == Counter([901, 903, 904, 906, 907, 908, 1, 4, None])
    assert N.keep_one(spark, clash.filter("false"), "").count() == 0


def test_stage_keeps_distinct_texts_of_one_id(spark, make, prose):
    rows = [(1, prose(11, 80)), (1, prose(12, 80)), (2, prose(13, 80)), (2, prose(13, 80)), (2, edited(prose(12, 80), 1, 1))]
    out = N.keep_one(spark, make(rows), "").collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter([rows[0], rows[1], rows[2]])


@pytest.mark.parametrize("own", [22, 8])
def test_family_with_shared_boilerplate(spark, make, prose, own):
    """Pairs over a common frame: at 22 own words only pairs are alike, at 8 nearly all are."""
    base = prose(1, 204)
    word = lambda *x: "w" + "x".join(map(str, x))
    rows = [(i, " ".join([base[: len(base) // 2], *(word("o", i, j) for j in range(60))])) for i in range(40)]
    for g in range(60):
        for m in range(2):
            text = " ".join([base, *(word("p", g, j) for j in range(10)), *(word("m", g, m, j) for j in range(own))])
            rows.append((100 + 2 * g + m, text))
    got = N.classes(make(rows)).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == classes_of(rows)


def test_prefixes_lose_no_pair(spark, make, prose):
    """Of random edits of a text and its halves all similar pairs share a short and a long prefix."""
    base = prose(3, 150)
    texts = [edited(base[: len(base) * (5 + i % 6) // 10], i, i % 12) for i in range(60)] + [base] * 2
    df = make(list(enumerate(dict.fromkeys(texts)))).selectExpr("encode(string(doc_id), 'utf-8') AS key", "text")
    rows = N.prefixes(df, 5, 0.8).collect()
    short, long = ({}, {})
    for r in rows:
        long.setdefault(int(r.key.decode()), set()).add(r.strip)
        if r.short:
            short.setdefault(int(r.key.decode()), set()).add(r.strip)
    bags = [bag(t) for t in dict.fromkeys(texts)]
    size = [sum(b.values()) for b in bags]
    for i in range(len(bags)):
        for j in range(len(bags)):
            if i != j and size[i] <= size[j] and similar(bags[i], bags[j]) >= 0.8:
                assert short.get(i, set()) & long.get(j, set())


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(1, 2), (3, 4), (4, 5), (9, 9)], []])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.u: r.v for r in components(df).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent if find(x) != x}
