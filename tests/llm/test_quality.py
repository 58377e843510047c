import re
from collections import Counter

import duckdb

from millrace.llm import quality


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    base = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), base


def test_measures(spark, make, odd, prose, sf_of):
    rows = [*odd, (1, prose(1, 200)), (2, "a b c a b c d a b"), (3, "the same line\nthe same line\n\n x\n x"), (4, "a a a a"), (5, "a a a"), (6, "#*$%&|<> " * 60)]
    got = quality.op6_quality_rules(spark, sf_of(documents=make(rows))).collect()
    want = Counter((i, *brute(t)) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert all(not (r.kept and r.base_failed) for r in got)


def test_verdicts(spark, make, sf_of):
    good = "The river is long and the boats of the town go to it with care for all that they have seen on the way. "
    rows = [(1, " ".join(good.replace("boats", f"boats{i}").replace("town", f"town{i}").replace("care", f"c{i}").replace("way", f"w{i}").replace("long", f"l{i}").replace("seen", f"s{i}") for i in range(6)))]
    rows.append((2, rows[0][1].replace(" ", "*** ")))
    rows.append((3, " ".join(f"q{i}x{i * 7}" for i in range(120))))
    rows.append((4, rows[0][1].replace(" ", "!! ")))
    got = {r.doc_id: r.kept for r in quality.op6_quality_rules(spark, sf_of(documents=make(rows))).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}


def test_sql_agrees_and_clashing_columns(spark, make, odd, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    found = con.execute(quality.sql())
    assert [d[0] for d in found.description] == names
    assert sorted(found.fetchall()) == sorted(tuple(r) for r in quality.op6_quality_rules(spark, sf).select(names).collect())
    clash = make(odd).selectExpr("*", "1 AS quality", "2 AS row", "3 AS kept")
    assert quality.keep_good(spark, clash, "").columns == clash.columns
    assert quality.keep_good(spark, clash.filter("false"), "").count() == 0


def test_native(spark, sf):
    plan = quality.op6_quality_rules(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
