import hashlib
import pickle
import re
import tracemalloc

import duckdb
import numpy as np

from millrace.llm import decontaminate as D
from millrace.llm.fm_index import FMIndex, WaveletMatrix, suffix_array


def test_index_equals_brute_force():
    rng = np.random.default_rng(1)
    for n, top in ((1, 3), (40, 3), (300, 9), (500, 2)):
        text = rng.integers(1, top + 1, n)
        full = np.concatenate([text, [0]])
        assert suffix_array(full).tolist() == sorted(range(n + 1), key=lambda i: full[i:].tolist())
        wave = WaveletMatrix(full, top + 1)
        symbols, at = rng.integers(0, top + 1, 50), rng.integers(0, n + 2, 50)
        assert wave.rank(symbols, at).tolist() == [int((full[:p] == s).sum()) for s, p in zip(symbols, at, strict=True)]
        phrases = [rng.integers(1, top + 1, k).tolist() for k in (1, 2, 3, 5) for _ in range(5)] + [text[: min(n, 7)].tolist()]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in phrases])])
        index = FMIndex(text, top + 1)
        which, where = index.locate(*index.search(np.concatenate(phrases), offsets[:-1], offsets[1:]))
        got = sorted(zip(which.tolist(), where.tolist(), strict=True))
        assert got == sorted((k, i) for k, p in enumerate(phrases) for i in range(n) if text[i : i + len(p)].tolist() == p)


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items):
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for name, body in items:
            b = words(body)
            k = min(13, len(b))
            grams = {tuple(b[j : j + k]) for j in range(len(b) - k + 1)} if b else set()
            for j in range(len(w) - k + 1 if k else 0):
                if tuple(w[j : j + k]) in grams:
                    hit |= set(range(j, j + k))
                    ids.add(str(name) if name is not None else "")
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


def _case(prose, odd):
    passage, short = prose(5, 40), "Just Three Words"
    docs = [*odd, (1, prose(1, 300)), (2, prose(2, 100) + " " + passage.upper() + ". " + prose(3, 100)), (3, " ".join(passage.split()[10:24])), (4, " ".join(passage.split()[10:22])), (5, f"a, just-three! WORDS {prose(6, 200)}"), (6, passage + " " + passage)]
    items = [(1, passage), (10, short), (2, passage), (3, None), (4, "…"), (5, "one"), (1, passage), (None, " ".join(passage.split()[20:]))]
    return docs, items


def test_query_equals_brute_force(spark, make, prose, odd, sf_of, monkeypatch):
    docs, items = _case(prose, odd)
    bench = spark.createDataFrame(items, "item_id long, text string")
    folder = sf_of(documents=make(docs), benchmark=bench)
    want = brute(docs, items)
    assert sorted(tuple(r) for r in D.op8_decontaminate(spark, folder).collect()) == want
    monkeypatch.setattr(D, "SLICE_BYTES", 300)  # several slices of the benchmark
    assert sorted(tuple(r) for r in D.op8_decontaminate(spark, folder).collect()) == want


def test_spans_and_stage(spark, make, prose, odd, sf_of):
    docs, items = _case(prose, odd)
    df, bench = make(docs), spark.createDataFrame(items, "item_id long, text string")
    found = {r.row.doc_id: r for r in D.find_contamination(df, bench).collect()}
    (span,) = found[2].spans
    assert words(docs[-5][1].encode()[span.start : span.end].decode()) == words(items[0][1])
    clash = df.selectExpr("*", "1 AS spans", "2 AS items", "3 AS n_hit", "4 AS row")
    folder = sf_of(benchmark=bench)
    kept = D.drop_contaminated(spark, clash, folder)
    assert kept.columns == clash.columns
    bad = {w[0] for w in brute(docs, items) if w[5]}
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - bad and bad
    assert D.drop_contaminated(spark, df.filter("false"), folder).count() == 0
    assert D.drop_contaminated(spark, df, sf_of(benchmark=bench.filter("false"))).count() == len(docs)


def test_sql_agrees(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    assert sorted(con.execute(D.SQL).fetchall()) == sorted(tuple(r) for r in D.op8_decontaminate(spark, sf).collect())


def test_a_slice_is_a_few_times_its_text():
    """So are the driver's memory for it and the broadcast."""
    rng = np.random.default_rng(2)
    vocabulary = ["".join(x) for x in rng.choice(list("abcdefghijklmnop"), (20_000, 6))]
    items = [(str(i), " ".join(rng.choice(vocabulary, 500))) for i in range(D.SLICE_BYTES // 3500)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    phrases = D.Phrases(items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert size > 0.9 * D.SLICE_BYTES and peak < 60 * size < 1e9
    assert len(pickle.dumps(phrases)) < 6 * size
    found = phrases.hits(D.ALNUM.words([items[7][1], "nothing here", items[9][1][100:300]]))
    assert {n for r, n in found[1] if r == 0} == {"7"} and {n for r, n in found[1] if r == 2} == {"9"}
