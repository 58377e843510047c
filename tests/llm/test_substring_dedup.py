import random
import re

from millrace.llm import substring_dedup as S


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def needed(rows, g=50):
    """Words of each document in a 50-word window that an earlier document has."""
    first, out = {}, {}
    for i, t in sorted(rows):
        w = words(t)
        grams = [tuple(w[p : p + g]) for p in range(len(w) - g + 1)]
        out[i] = {q for p, k in enumerate(grams) if k in first and first[k] != i for q in range(p, p + g)}
        for k in grams:
            first.setdefault(k, i)
    return out


def test_finds_every_exact_passage(spark, make, prose, odd, sf_of):
    rng = random.Random(1)
    passages = [prose(500 + i, rng.randint(51, 120)) for i in range(6)]
    rows = [(i, t) for i, t in odd if i != 904]
    for i in range(60):
        body = [prose(1000 + 7 * i + k, rng.randint(30, 200)) for k in range(3)]
        for p in rng.sample(passages, rng.randint(0, 2)):
            body.insert(rng.randint(0, len(body)), p)
        rows.append((i, " ".join(body)))
    rows += [(100 + i, prose(3, 300)) for i in range(10)]  # copies
    got = {}
    for r in S.op3_substring_dedup(spark, sf_of(documents=make(rows))).collect():
        assert r.earlier_doc_id < r.doc_id
        got.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
    want = needed(rows)
    for i, w in want.items():  # beyond a passage's end, a later holder may share a word by chance that the first lacks
        left = w - got.get(i, set())
        assert len(left) <= 2 and all({p - 2, p - 1, p + 1, p + 2} & got[i] for p in left)
    clean = {i for i, w in want.items() if not w}
    assert not clean & set(got) - {908}


def test_fuzzy_passage_is_one_span(spark, make, prose, sf_of):
    p = prose(1, 100).split()
    q = [*p]
    q[30], q[60] = "changed", "other"
    del q[80]
    q.insert(90, "added")
    rows = [(1, f"{prose(2, 60)} {' '.join(p)} {prose(3, 60)}"), (2, f"{prose(4, 40)} {' '.join(q)} {prose(5, 40)}"), (3, prose(6, 200))]
    (r,) = S.op3_substring_dedup(spark, sf_of(documents=make(rows))).collect()
    assert (r.doc_id, r.earlier_doc_id, r.first_word, r.n_words, r.n_matched) == (2, 1, 40, 100, 97)


def test_stage_cuts_all_but_the_first(spark, make, prose, odd):
    p = prose(1, 80)
    rows = [*odd, (1, f"ä {prose(2, 70)}\n{p}! {prose(3, 70)}"), (2, f"{prose(4, 70)} ({p}) ü"), (3, p), (4, prose(5, 90))]
    clash = make(rows).selectExpr("*", "1 AS doc", "2 AS other", "3 AS row", "4 AS _spans", "5 AS h")
    out = S.cut_repeats(spark, clash, "")
    assert out.columns == clash.columns and out.count() == len(rows)
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == rows[-4][1] and got[4].text == rows[-1][1]
    assert got[2].text == f"{prose(4, 70)} () ü" and got[3].text == ""
    assert all(r.n_chars == len(r.text or "") for r in got.values() if r.doc_id in (2, 3))
    assert S.cut_repeats(spark, clash.filter("false"), "").count() == 0


def test_chains_follow_the_diagonal():
    xs, ys = [0, 10, 20, 30, 200, 210, 15], [5, 15, 26, 36, 100, 110, 500]
    got = sorted(S.chains(xs, ys))
    assert got == [[0, 1, 2, 3], [4, 5], [6]]


def test_fenwick_is_a_prefix_maximum():
    rng = random.Random(2)
    tree, seen = S.Fenwick(30), []
    for i in range(200):
        at, v = rng.randint(1, 30), rng.random()
        tree.put(at, (v, i))
        seen.append((at, (v, i)))
        q = rng.randint(0, 30)
        assert tree.upto(q) == max([x for a, x in seen if a <= q], default=(-1e18, -1))


def test_every_copy_inside_a_document_is_a_repeat(spark, make, prose, sf_of):
    p = prose(1, 55)
    rows = [(1, f"{prose(2, 30)} {p}"), (2, " ".join([p] * 6)), (3, f"{p}\n{prose(3, 100)}\n{p}")]
    got = {}
    for r in S.op3_substring_dedup(spark, sf_of(documents=make(rows))).collect():
        got.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
    assert got == {2: set(range(330)), 3: set(range(55)) | set(range(155, 210))}


def test_chain_less_alike_keeps_its_parts(spark, make, prose, sf_of):
    p, q, r = prose(1, 55), prose(2, 55), prose(3, 55)
    rows = [
        (1, f"{p} {prose(10, 30)} {q}"),
        (2, f"{p} {q}"),  # 110 of 140 words
        (3, f"{r} {prose(11, 20)} {prose(12, 8)}"),
        (4, f"{r} {prose(13, 20)} {prose(12, 8)} {prose(14, 40)}"),  # and a common phrase
    ]
    got = {}
    for x in S.op3_substring_dedup(spark, sf_of(documents=make(rows))).collect():
        got.setdefault(x.doc_id, set()).update(range(x.first_word, x.first_word + x.n_words))
    assert got[2] == set(range(110)) and set(range(55)) <= got[4] <= set(range(57))


def test_longest_parts_of_a_chain():
    import numpy as np

    rng = np.random.default_rng(1)
    one, two = rng.integers(0, 1 << 30, (2, 40))
    # 40 + 12 + 40 words are alike at 0.87; the seed 30 words on is not part of it
    far = rng.integers(0, 1 << 30, 8)
    a = np.concatenate([one, rng.integers(0, 1 << 30, 12), two, rng.integers(0, 1 << 30, 30), far])
    b = np.concatenate([one, rng.integers(0, 1 << 30, 12), two, rng.integers(0, 1 << 30, 30), far])
    anchors = [(0, 0), (32, 32), (52, 52), (84, 84), (122, 122)]
    assert S.align(a, b, anchors) is None
    assert S.pieces(a, b, anchors) == [(0, 92, 80)]


def test_chains_are_the_best_there_are():
    """Against a program that looks at all pairs of points."""
    rng = random.Random(8)
    for turn in range(200):
        n = rng.randint(1, 40)
        xs = rng.sample(range(300), n)
        ys = [min(299, max(0, x + rng.choice([0, 0, 0, 5, -40, 90, -100]))) if turn % 2 else rng.randrange(300) for x in xs]
        best = {}
        for i in sorted(range(n), key=lambda i: xs[i]):
            ways = [best[j] - S.GAP_COST * (xs[i] - xs[j] + ys[i] - ys[j]) for j in best if 0 < xs[i] - xs[j] <= S.MAX_GAP and 0 < ys[i] - ys[j] <= S.MAX_GAP]
            best[i] = S.K + max([0.0, *ways])
        found = S.chains(xs, ys)
        worth = lambda c: S.K * len(c) - S.GAP_COST * sum(xs[b] - xs[a] + ys[b] - ys[a] for a, b in zip(c, c[1:]))  # noqa: B905, E731
        assert sorted(i for c in found for i in c) == list(range(n))
        assert abs(max(worth(c) for c in found) - max(best.values())) < 1e-9
