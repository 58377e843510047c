import random

import pytest

from millrace.operators import batches, cascade
from millrace.plans import report
from millrace.streaming.curate import curate

SCHEMA = (
    "ord long, source string, page_url string, image_url string, title string, has_hull_in_title boolean, sha1 string, dhash string, bits long, "
    "tokens array<struct<text:string,conf:double>>, content_type string, error_type string, n_bytes long, img_type string, w int, h int, sharpness double"
)


def _rows(n=60, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(1, n + 1):
        hull = rng.random() < 0.5
        out.append(
            (i, "bing", f"p{rng.randrange(4)}", f"http://h/{i}.jpg", "", hull, f"s{rng.randrange(25)}", rng.choice([f"d{rng.randrange(20)}", ""]), rng.getrandbits(62),
             [(rng.choice(["51", "none", "a text that is far too long 1"]), 0.5)], rng.choice(["image/jpeg", "", "image/png", "text/html"]), rng.choice(["", "", "", "", "Timeout"]),
             rng.choice([20000, 20000, 20000, 100]), rng.choice(["jpeg", "png", "gif"]), rng.choice([800, 800, 499, None]), 600, rng.choice([99.0, 99.0, 59.9]))
        )
    return out


def _brute(rows, size, target, mode, known):
    sha1, dhash, pages, total, out = set(known), set(), {}, 0, {}
    for b in range(0, len(rows), size):
        if total >= target:
            break
        had_sha1, had_dhash, had_pages = set(sha1), set(dhash), dict(pages)
        now_sha1, now_dhash, now_pages, taken = set(), set(), {}, 0
        for r in rows[b : b + size]:
            i, _, page, _, _, hull, s, d, _, tokens, ct, err, nb, kind, w, h, sharp = r
            ocr = hull or tokens[0][0] == "51"

            def first():
                if had_pages.get(page, 0) >= 3:
                    return "per_page_limit"
                if not err and ct and not ct.startswith("image/"):
                    return "non_image_content_type"
                if err:
                    return f"download_failed_{err}"
                if nb < 10240:
                    return "too_small_file"
                if kind == "gif":
                    return "invalid_format"
                if s in had_sha1:
                    return "duplicate_sha1"
                if w is None:
                    return "corrupt_image"
                if w < 500:
                    return "too_small_dims"
                if sharp < 60:
                    return "blurry"
                if d and d in had_dhash:
                    return "near_duplicate"
                if mode == "strict":
                    if had_pages.get(page, 0) + now_pages.get(page, 0) >= 3:
                        return "per_page_limit"
                    if s in now_sha1:
                        return "duplicate_sha1"
                    if d and d in now_dhash:
                        return "near_duplicate"
                if total + taken >= target:
                    return "quota_dropped"
                return "accepted" if ocr else "no_digits_or_too_long"

            out[i] = first()
            if out[i] == "accepted":
                taken += 1
                now_sha1.add(s)
                now_dhash |= {d} - {""}
                now_pages[page] = now_pages.get(page, 0) + 1
        total += taken
        sha1 |= now_sha1
        dhash |= now_dhash
        for p, n in now_pages.items():
            pages[p] = pages.get(p, 0) + n
    return out


@pytest.mark.parametrize("mode", ["snapshot", "strict"])
def test_loop_equals_simulation(spark, tmp_path, mode):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame([("s3",), ("",)], "sha1 string")
    limits = batches.Limits(target=9, batch_size=12)
    out = batches.run(spark, df, known, limits=limits, mode=mode, state=f"file://{tmp_path}/state")
    got = {r.ord: r.disposition for r in out.collect()}
    assert got == _brute(rows, 12, 9, mode, {"s3"})
    one = report.report(out, 9, 3600.0).first()
    assert one.total_candidates == len(got) and one.accepted == sum(v == cascade.ACCEPTED for v in got.values())
    assert "| accepted |" in report.markdown(one)


def test_resume_accepts_nothing_twice(spark, tmp_path):
    rows = _rows(seed=2)
    df, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], "sha1 string")
    state = f"file://{tmp_path}/state"
    first = batches.run(spark, df, known, limits=batches.Limits(batch_size=10, max_batches=3), mode="strict", state=state)
    assert first.select("batch").distinct().count() == 3
    out = batches.run(spark, df, known, limits=batches.Limits(batch_size=10), mode="strict", state=state)
    assert {r.ord: r.disposition for r in out.collect()} == _brute(rows, 10, 5000, "strict", set())
    again = batches.run(spark, df, known, limits=batches.Limits(batch_size=10), mode="strict", state=state)
    assert again.count() == len(rows)


def test_hamming_mode_and_empty(spark, tmp_path):
    rows = [list(r) for r in _rows(4)]
    for i, r in enumerate(rows):
        r[2], r[5], r[6], r[7], r[8] = f"p{i}", True, f"s{i}", f"d{i}", 7 ^ (1 << i if i < 3 else (1 << 40) - 1)
        r[10:] = ["image/jpeg", "", 20000, "jpeg", 800, 600, 99.0]
    df, known = spark.createDataFrame([tuple(r) for r in rows], SCHEMA), spark.createDataFrame([], "sha1 string")
    out = batches.run(spark, df, known, limits=batches.Limits(batch_size=1), near="hamming", state=f"file://{tmp_path}/s")
    assert [r.disposition for r in out.orderBy("ord").collect()] == ["accepted", "near_duplicate", "near_duplicate", "accepted"]
    assert batches.run(spark, df.filter("false"), known, state=f"file://{tmp_path}/t").count() == 0


def test_stream(spark, tmp_path):
    rows = _rows(20, 4)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in")
    known = spark.createDataFrame([], "sha1 string")
    for _ in range(2):  # the second start finds nothing new
        query = curate(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), known, f"file://{tmp_path}/state", f"{tmp_path}/check", target=100)
        query.awaitTermination(120)
    got = {r.ord: r.disposition for r in spark.read.parquet(f"{tmp_path}/state").collect()}
    assert got == _brute(rows, 20, 100, "strict", set())


def test_strict_hamming_inside_a_batch(spark, tmp_path):
    rows = [list(r) for r in _rows(4)]
    for i, r in enumerate(rows):
        r[2], r[5], r[6], r[7], r[8] = f"p{i}", True, f"s{i}", f"d{i}", 7 ^ (1 << i if i < 3 else (1 << 40) - 1)
        r[10:] = ["image/jpeg", "", 20000, "jpeg", 800, 600, 99.0]
    df, known = spark.createDataFrame([tuple(r) for r in rows], SCHEMA), spark.createDataFrame([], "sha1 string")
    out = batches.run(spark, df, known, limits=batches.Limits(batch_size=4), mode="strict", near="hamming", state=f"file://{tmp_path}/s")
    assert [r.disposition for r in out.orderBy("ord").collect()] == ["accepted", "near_duplicate", "near_duplicate", "accepted"]


def test_stream_in_parts(spark, tmp_path):
    """A micro-batch that is too long for one task is judged in parts, in order."""
    rows = _rows(40, 6)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in")
    known = spark.createDataFrame([], "sha1 string")
    curate(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), known, f"file://{tmp_path}/state", f"{tmp_path}/check", target=100, rows=15).awaitTermination(120)
    found = spark.read.parquet(f"{tmp_path}/state")
    assert found.select("part").distinct().count() == 3
    assert {r.ord: r.disposition for r in found.collect()} == _brute(rows, 40, 100, "strict", set())


def test_urls_of_earlier_batches_are_not_tried_again(spark, tmp_path):
    rows = [list(r) for r in _rows(6)]
    for i, r in enumerate(rows):
        r[2], r[3], r[5], r[6], r[7] = f"p{i}", f"http://h/{i % 2}.jpg", True, f"s{i}", ""
        r[10:] = ["image/jpeg", "Timeout" if i % 2 else "", 20000, "jpeg", 800, 600, 99.0]
    df, known = spark.createDataFrame([tuple(r) for r in rows], SCHEMA), spark.createDataFrame([], "sha1 string")
    out = batches.run(spark, df, known, limits=batches.Limits(batch_size=2), state=f"file://{tmp_path}/s")
    assert [(r.ord, r.disposition) for r in out.orderBy("ord").collect()] == [(1, "accepted"), (2, "download_failed_Timeout")]
