import functools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import toxicity as X


def test_block_max_is_exact():
    rng = np.random.default_rng(1)
    at, terms, weights, full = [0], [], [], np.zeros((700, 80))
    for i in range(700):
        t = np.sort(rng.choice(80, rng.integers(0, 8), replace=False))
        w = rng.random(len(t)) + 0.1
        w /= np.sqrt(w @ w) or 1
        full[i, t] = w
        at.append(at[-1] + len(t))
        terms += t.tolist()
        weights += w.tolist()
    at, terms, weights = np.array(at), np.array(terms), np.array(weights)
    index = X.BlockMaxIndex(at, terms, weights, 80)
    for i in range(80):
        some = slice(at[i], at[i + 1])
        place, cosine = index.nearest(terms[some], weights[some], 10)
        want = full @ full[i]
        assert np.allclose(cosine, np.sort(want[want > 0])[::-1][:10], atol=1e-6)
        assert np.allclose(want[index.order[place]], cosine, atol=1e-6)


def _case(prose, n=600):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        w = prose(i, 60).split()
        toxic = rng.random() < 0.2
        if toxic:
            for bad in rng.sample(["vile", "rotten", "filthscum", "filthpig", "filthrat"], 2):
                w.insert(rng.randrange(len(w)), bad)
        rows.append((i, " ".join(w)))
        if rng.random() < 0.6:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out(spark, make, prose, odd, sf_of):
    rows, labels = _case(prose)
    noisy = [*labels, (None, 1, 1), (10_000, 1, 1), (labels[0][0], 1, labels[0][2]), (5, 1, None)]
    got = X.op1_toxicity(spark, sf_of(documents=make([*odd, *rows]), labels=spark.createDataFrame(noisy, "doc_id long, quality int, toxic int"))).collect()
    assert len(got) == len(odd) + len(rows)
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    told = [(by[i].predicted, t) for i, _, t in labels if by[i].held_out]
    assert sum(p == t for p, t in told) >= 0.97 * len(told) and any(t for _, t in told)
    assert by[901].predicted == by[902].predicted == 0


def test_labels_of_the_held_out_quarter_change_nothing(spark, make, prose, sf_of):
    rows, labels = _case(prose, 200)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    docs = make(rows)
    scores = [sorted(tuple(r) for r in X.op1_toxicity(spark, sf_of(documents=docs, labels=spark.createDataFrame(x, "doc_id long, quality int, toxic int"))).collect()) for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_neighbours_are_those_of_whole_texts(spark, make, prose, sf_of):
    """The query's evidence by brute force: every word of every text, weighed by hand."""
    rows, labels = _case(prose, 150)
    learned = [(i, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 4 != 2]
    repeated = [*rows, (learned[0][0], prose(999, 40)), rows[3], rows[3]]
    got = X.op1_toxicity(spark, sf_of(documents=make(repeated), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).collect()
    docs = make(repeated).selectExpr("doc_id AS id", "text")
    model = X.fit(docs, spark.createDataFrame(learned, "id long, toxic int"))[0].value
    bags = [Counter(_terms(t, model)) for _, t in repeated]
    df = Counter(x for b in bags for x in b)
    chosen = {}
    for (i, text), b in zip(repeated, bags, strict=True):
        chosen.setdefault(i, []).append((text, b))
    label = dict(learned)
    texts = {r.id: r.text for r in docs.join(spark.createDataFrame(learned, "id long, toxic int"), "id").groupBy("id").agg(F.min_by("text", F.xxhash64("text")).alias("text")).collect()}
    examples = {i: Counter(_terms(t, model)) for i, t in texts.items()}
    n, toxic = len(examples), sum(label[i] for i in examples)
    has = Counter(x for b in examples.values() for x in b)
    bad = Counter(x for i, b in examples.items() if label[i] for x in b)

    def weight(x):
        return (math.log((1 + len(repeated)) / (1 + df[x])) + 1) * (1 + float(X.ratio(np.array([has[x]]), np.array([bad[x]]), n, toxic)[0]))

    def vector(b):
        v = {x: (1 + math.log(k)) * weight(x) for x, k in b.items() if x in has}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {x: w / norm for x, w in v.items()}

    unit = {i: vector(b) for i, b in examples.items()}
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for (i, text), b in list(zip(repeated, bags, strict=True))[:40]:
        query = vector(b)
        cosines = sorted((sum(w * e.get(x, 0.0) for x, w in query.items()) for e in unit.values()), reverse=True)
        assert any(np.allclose(r.evidence_cosines, cosines[: X.EVIDENCE], atol=1e-5) for r in by[i])
    for r in got:
        assert all(label[e] == t for e, t in zip(r.evidence_ids, r.evidence_toxic, strict=True))


def _terms(text, model):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    known = set(model.beginnings.tolist())
    heads = [h for x in w for h in (_head(x.encode(), k) for k in X.PREFIXES if len(x.encode()) > k) if h in known]
    return [X.ALNUM.hash(x) for x in w] + heads


@functools.lru_cache(None)
def _head(word, k):
    return int(X.lex(X.ALNUM, pa.array([word.decode()]), (k,)).prefix[k][0])


def test_votes_and_calibration():
    assert X.monotone(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0, 1, 0, 1]), 0.5)[1].tolist() == sorted(X.monotone(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0, 1, 0, 1]), 0.5)[1])
    model = X.Model(np.arange(3), np.array([0, 1, 1]), np.array([0, 1, 2, 3]), np.array([5, 6, 5], np.uint64), np.ones(3), np.zeros(0, np.uint64))
    model.weigh(np.ones(2), 9)
    near = model.vote(np.array([0, 1]), np.array([0.9, 0.2]))
    own = model.labels[:2]
    want = (own @ [1 / 0.2, 1 / 0.9] + X.PRIOR * 2 / 3) / (1 / 0.2 + 1 / 0.9 + X.PRIOR)
    assert abs(near - want) < 1e-9


def test_degenerate_tables(spark, make, prose):
    rows, labels = _case(prose, 120)
    docs = make(rows).selectExpr("doc_id AS id", "text", "1 AS terms", "2 AS toxic")
    frame = spark.createDataFrame([(i, t) for i, _, t in labels], "id long, toxic int")
    for d, f in ((docs.filter("false"), frame), (docs, frame.filter("false")), (docs, frame.filter("toxic = 0"))):
        out = X.score(d.select("id", "text"), f)
        assert out.count() == d.count() and not out.filter("score > 0.3").count()
