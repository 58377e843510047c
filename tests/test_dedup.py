from pyspark.sql import functions as F

from millrace.operators import cascade, dedup, graph, select


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_seen(spark):
    df = spark.createDataFrame([(3, "a", "x"), (1, "a", "y"), (2, "b", None), (4, None, "z")], "ord int, k string, v string")
    assert sorted((r.k or "", r.v) for r in dedup.first_seen(df, ["k"], ["ord"]).collect()) == [("", "z"), ("a", "y"), ("b", None)]


def test_history(spark):
    cand = spark.createDataFrame([("http://h/a.jpg", "p1"), ("http://h/b_tn.jpg", "p2"), ("http://h/c.jpg", "p3"), ("http://h/d.jpg", ""), ("", "p5")], "image_url string, page_url string")
    hist = spark.createDataFrame([("http://h/a.jpg", "http://h/a.jpg", ""), ("http://h/B.jpg", "http://h/b.jpg", "p3"), ("", "", "")], "image_url string, canonical_url string, page_url string")
    out = dedup.against_history(cand, hist)
    assert sorted(r.image_url for r in out.collect()) == ["", "http://h/d.jpg"]
    assert sorted(r.image_url for r in dedup.against_history(cand, hist, page_rule=False).collect()) == ["", "http://h/c.jpg", "http://h/d.jpg"]
    assert "NestedLoop" not in _plan(out) and "Cartesian" not in _plan(out)


def test_pending_and_merge(spark):
    cand = spark.createDataFrame([("s", "a", 1), ("s", "b", 2), ("s", "c", 3), ("s", "c", 4)], "source string, image_url string, ord int")
    one = lambda *x: spark.createDataFrame([(v,) for v in x], "image_url string")
    assert sorted(r.image_url for r in dedup.pending(cand, one("a"), one("b", "")).collect()) == ["c", "c"]
    merged = dedup.merge_new(cand.filter("image_url = 'a'"), cand, ["ord"])
    assert sorted((r.image_url, r.ord) for r in merged.collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_orphans(spark):
    files = spark.createDataFrame([("a.jpg",), ("b.jpg",)], "file_name string")
    raws = spark.createDataFrame([("b.png",), ("b.txt",), ("a.png",)], "file_name string")
    gone = dedup.orphans(files, files.filter("file_name = 'a.jpg'"))
    assert [r[0] for r in gone.collect()] == ["b.jpg"]
    assert [r[0] for r in dedup.orphan_raws(gone, raws).collect()] == ["b.png"]


def test_cap_uses_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    out = select.cap(df, ["g"], [F.col("id")], 3)
    assert sorted(r.id for r in out.collect()) == list(range(9))
    assert "WindowGroupLimit" in _plan(out)


def test_numbered_and_split(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("tie"))
    got = {r.id: r.position for r in select.numbered(df, [F.col("tie"), F.col("id")], F.col("tie"), "position").collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda x: x[1])] == sorted(range(1000), key=lambda i: (i % 7, i)) and set(got.values()) == set(range(1, 1001))
    for n in (0, 1, 2, 7, 100):
        parts = [r["split"] for r in select.split(spark.range(n), F.col("id")).collect()]
        assert parts.count("train") == (max(1, int(n * 0.85)) if n > 1 else n)
    assert select.sample(spark.range(10), F.col("id"), 30).count() == 10


def test_quota(spark):
    df = spark.range(100)
    taken = {r.id for r in select.quota(df, F.col("id") % 2 == 0, [F.col("id")], F.col("id"), 10).filter("taken").collect()}
    assert taken == set(range(0, 20, 2)) and select.quota(df, F.lit(False), [F.col("id")], F.col("id"), 5).count() == 100


def test_snapshot_rules_equal_the_loop(spark):
    import random

    rng = random.Random(5)
    rows = [(i, i // 6, rng.choice("abcd"), rng.choice(["x", "y", ""]), rng.random() < 0.7) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, batch int, page string, sha1 string, ok boolean")
    seen, want = set(), {}
    for b in range(10):
        batch = [r for r in rows if r[1] == b]
        for r in batch:
            want[r[0]] = r[4] and (r[3] == "" or r[3] not in seen)
        seen |= {r[3] for r in batch if want[r[0]]}
    assert {r.id: r.accepted for r in select.snapshot_keys(df, "sha1", "batch", F.col("ok")).collect()} == want
    pages, want = {}, {}
    for b in range(10):
        batch = [r for r in rows if r[1] == b]
        for r in batch:
            want[r[0]] = r[4] and pages.get(r[2], 0) < 3
        for r in batch:
            pages[r[2]] = pages.get(r[2], 0) + want[r[0]]
    assert {r.id: r.accepted for r in select.snapshot_cap(df, "page", "batch", F.col("ok"), 3).collect()} == want


def test_disposition_and_rollup(spark):
    df = spark.createDataFrame([(1, 5, None), (2, 50, "x"), (3, 500, "Timeout"), (4, 500, None)], "i int, n int, e string")
    rules = [("small", F.col("n") < 10), (F.concat(F.lit("download_failed_"), "e"), F.col("e").isNotNull() & (F.col("n") > 100)), ("odd", F.col("e") == "x")]
    out = df.withColumn("disposition", cascade.disposition(rules))
    assert [r.disposition for r in out.orderBy("i").collect()] == ["small", "odd", "download_failed_Timeout", "accepted"]
    got = {(r.reason, r.error_type): r.n for r in cascade.failure_rollup(out).collect()}
    assert got == {("small", None): 1, ("odd", None): 1, ("accepted", None): 1, ("download_failed", None): 1, ("download_failed", "Timeout"): 1}


def test_reach_with_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 3), (5, 6)], "src long, dst long")
    roots = spark.createDataFrame([(1,)], "node long")
    assert {r.node: r.depth for r in graph.reach(edges, roots).collect()} == {1: 0, 2: 1, 3: 2}
    assert {r.node for r in graph.reach(edges, roots, max_found=1).collect()} == {1, 2}
    assert [r.node for r in graph.one_hop(edges, roots).collect()] == [2]
