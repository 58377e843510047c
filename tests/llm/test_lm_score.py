import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import lm_score as L

TEXTS = ["a b c a b", "zz a, Words-of c", "", None, "b " * 7, "ünï a"]


def _network(words=("a", "b", "c")):
    return L.Network(np.array([L.ALNUM.hash(w) for w in words], np.uint64))


def _symbols(network, text):
    inner, outer = [], []
    words = L.ALNUM.words([text])
    body = (text or "").encode()
    for s, e, h in zip(words.start, words.end, words.hash, strict=True):
        at = np.flatnonzero(network.frequent == h)
        n, last = int(e - s), body[e - 1 : e].lower()[0]
        cls = min((n - 1) // 2, L.LENGTHS - 1) * L.LETTERS + last % L.LETTERS
        inner.append(1 + int(at[0]) if len(at) else 1 + len(network.frequent) + cls)
        outer.append(1 + min(n // 2, 2) if len(at) else 4 + min((n - 1) // 4, 3))
    return inner, outer


def _by_hand(network, text):
    """log p of every symbol, one position at a time."""
    inner, outer = _symbols(network, text)
    at = lambda x, i: x[i] if 0 <= i < len(x) else 0
    out = []
    for i, own in enumerate(inner):
        total = network.near[0][at(inner, i - 1)] + network.near[1][at(inner, i + 1)] + network.far[0][at(outer, i - 2)] + network.far[1][at(outer, i + 2)]
        logits = np.tanh(total) @ network.out + network.bias
        out.append(float(logits[own] - np.log(np.exp(logits.astype(np.float64)).sum())))
    return out


def test_probabilities_equal_a_loop():
    network = _network()
    found = network.read(pa.array(TEXTS))
    got = network.log_probabilities(found.contexts(), found.targets())
    want = [x for t in TEXTS for x in _by_hand(network, t)]
    assert np.allclose(got, want, atol=1e-5)
    assert network.read(pa.array(TEXTS)).words.row.tolist() == sorted(found.words.row.tolist())


def test_gradient_equals_differences():
    network = _network()
    for name in ("near", "far", "out", "bias"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    found = network.read(pa.array(TEXTS))
    context, row = np.unique(found.contexts(), return_inverse=True)
    pairs, n = np.unique(np.stack([row, found.targets()]), axis=1, return_counts=True)

    def loss():
        return -sum(k * math.log(p) for (r, t), k in zip(pairs.T, n, strict=True) if (p := _p(r, t))) / n.sum()

    def _p(r, t):
        logits = network.hidden(network.places(context[r : r + 1])) @ network.out + network.bias
        return float(np.exp(logits[0, t]) / np.exp(logits[0]).sum())

    by_out, by_bias, back = network.gradient(network.places(context), pairs[0], pairs[1], n)
    places = network.places(context)
    rng = random.Random(1)
    checks = [(network.out, (rng.randrange(L.HIDDEN), int(t)), by_out[..., :]) for t in pairs[1][:3]]
    for weight, at, grad in [*checks, (network.bias, (int(pairs[1][0]),), by_bias)]:
        old = weight[at]
        weight[at] = old + 1e-5
        up = loss()
        weight[at] = old - 1e-5
        down = loss()
        weight[at] = old
        assert abs((up - down) / 2e-5 - grad[at]) < 1e-6
    for table, place in ((network.near[0], places[0]), (network.near[1], places[1]), (network.far[0], places[2]), (network.far[1], places[3])):
        token = int(place[0])
        want = back[place == token].sum(axis=0)[5]
        old = table[token, 5]
        table[token, 5] = old + 1e-5
        up = loss()
        table[token, 5] = old - 1e-5
        down = loss()
        table[token, 5] = old
        assert abs((up - down) / 2e-5 - want) < 1e-6


def test_scores_equal_a_loop(spark, make, odd, prose, monkeypatch):
    """Every document's sum by hand from the model's network and counts of all words."""
    monkeypatch.setattr(L, "KNOWN", 60)
    monkeypatch.setattr(L, "FREQUENT", 12)
    rows = [(i, t) for i, t in odd if len(t or "") < 1000] + [(i, prose(i, 60)) for i in range(40)] + [(100 + i, prose(3, 60)) for i in range(3)]
    docs = make(rows)
    model = L.train(docs.select("text"))
    assert 0 < len(model.known) <= 60
    counts = Counter(h for _, t in rows for h in L.ALNUM.words([t]).hash.tolist())
    sums = Counter()
    for _, t in rows:
        words, cls = L.classed(pa.array([t], pa.string()))
        for h, c in zip(words.hash.tolist(), cls.tolist(), strict=True):
            sums[c] += h not in model.network.frequent
    got = sorted((r.row.doc_id, r.n_tokens, r.log_prob) for r in L.score(docs, model=model).collect())
    want = []
    for i, t in rows:
        words, cls = L.classed(pa.array([t], pa.string()))
        total = sum(_by_hand(model.network, t))
        for h, c in zip(words.hash.tolist(), cls.tolist(), strict=True):
            if h not in model.network.frequent:
                total += math.log(counts[h] / (sums[c] + 1))
        want.append((i, len(words.hash), total))
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:2] == w[:2] and abs(g[2] - w[2]) < 1e-3 * max(1, abs(w[2]))


def test_partitions_do_not_matter(spark, make, prose, monkeypatch):
    monkeypatch.setattr(L, "GROUP", 500)
    docs = make([(i, prose(i % 50, 80)) for i in range(80)])
    one, four = ({r.row.doc_id: r.log_prob for r in L.score(docs.repartition(n)).collect()} for n in (1, 4))
    assert all(abs(one[i] - four[i]) < 1e-6 * abs(one[i]) for i in one)


def test_texts_that_stand_twice_are_likelier(spark, make):
    rng = random.Random(5)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(7)) if rng.random() < 0.3 else rng.choice(["of", "the", "and", "to"]) for _ in range(60))
    once, twice = [text() for _ in range(60)], [text() for _ in range(20)]
    found = {r.row.doc_id: r.mean_log_prob for r in L.score(make([*enumerate(once), *((100 + i, t) for i, t in enumerate(twice)), *((200 + i, t) for i, t in enumerate(twice))])).collect()}
    limit = np.quantile([found[i] for i in range(60)], 0.9)
    assert np.mean([found[100 + i] > limit for i in range(20)]) >= 0.9
    assert all(found[100 + i] == found[200 + i] for i in range(20))


def test_scores(spark, make, odd, prose, sf_of):
    rows = [*odd, *((i, prose(i, 150)) for i in range(80)), (300, "q9 " + " ".join(reversed("zeta theta iota kappa".split() * 30)))]
    got = {r.doc_id: r for r in L.op4_lm_scoring(spark, sf_of(documents=make(rows))).collect()}
    assert len(got) == len({i for i, _ in rows})
    for i in (901, 902, 903):
        assert (got[i].n_tokens, got[i].log_prob, got[i].mean_log_prob) == (0, 0.0, None)
    assert got[904].mean_log_prob == got[905].mean_log_prob < 0 and got[908].n_tokens == 100_000
    assert all(abs(r.log_prob / r.n_tokens - r.mean_log_prob) < 1e-9 and r.log_prob < 0 for r in got.values() if r.n_tokens)


def test_learns_from_both_sides(spark, make):
    rng = np.random.default_rng(1)
    text = lambda: " ".join(f"{x}l {x}m {x}r" for x in rng.choice(list("abcdef"), 100))
    network = L.train(make([(i, text()) for i in range(200)]).select("text")).network
    found = network.read(pa.array([text()]))
    mean = network.log_probabilities(found.contexts(), found.targets())
    assert mean[1::3].mean() > -0.7 > -np.log(18)  # both neighbours tell the middle word


def test_empty_clash_and_levels(spark, make, monkeypatch):
    clash = make([(1, "a b"), (2, None)]).selectExpr("*", "1 AS n_tokens", "2 AS row", "3 AS log_prob")
    assert L.score(clash.filter("false")).count() == 0
    assert L.score(clash).select("row.*").columns == clash.columns
    monkeypatch.setattr(L, "FAN_IN", 2)
    rows = [(p, 1 + p, np.full(4, float(p), "<f4").tobytes()) for p in range(9)]
    df = spark.createDataFrame(rows, "part long, n long, weights binary")
    want = sum(p * (1 + p) for p in range(9)) / sum(1 + p for p in range(9))
    assert np.allclose(L._average(df), want)


@pytest.mark.parametrize("held", [10, 1 << 20])
def test_every_position_is_counted(spark, make, prose, monkeypatch, held):
    rows = [(i, prose(i, 1 + 2 * (i % 30))) for i in range(60)]
    network = _network(("ka", "lo"))
    monkeypatch.setattr(L, "_HELD", held)
    got = Counter()
    column = pa.array([t for _, t in rows])
    for batch in L._windows(network)(iter([pa.RecordBatch.from_arrays([column.slice(lo, 20)], names=["t"]) for lo in (0, 20, 40)])):
        for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            got[w] += n
    found = network.read(column)
    assert got == Counter((found.contexts() * network.size + found.targets()).tolist()) and sum(got.values()) == sum(len(t.split()) for _, t in rows)
