import numpy as np

from millrace.__main__ import main
from millrace.functions import images
from millrace.plans import lifecycle


def _png(seed, w=520, h=360):
    return bytearray(images.encode_png(np.random.default_rng(seed).integers(0, 256, (h, w, 3), np.uint8)))


def test_run(spark, tmp_path):
    lines = ["source,image_url,page_url,title,has_hull_in_title"]
    lines += [f"bing,http://h/{i}.png,http://p/{i % 3},USS DDG-{i},True" for i in range(8)]
    lines += ["bing,http://h/0.png,http://p/9,again,True", "usni,http://h/old.png,http://p/old,x,False", "other,http://h/z.png,,x,False", "usni,http://h/none.png,,x,False"]
    (tmp_path / "c.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "hist").mkdir()
    (tmp_path / "hist/accepted.csv").write_text("file_name,source,page_url,image_url,title,orig_width,orig_height,sharpness,ocr_text,ocr_conf,sha1,dhash,hull_in_title\nf,usni,http://p/old,http://h/x.png,t,1,1,1,,1,abc,,True\n")
    rows = [(f"http://h/{i}.png", _png(i), "image/png", None, []) for i in range(6)]
    rows += [("http://h/6.png", _png(5), "image/png", None, []), ("http://h/7.png", None, None, "Timeout", [])]
    spark.createDataFrame(rows, "image_url string, content binary, content_type string, error_type string, tokens array<struct<text:string,conf:double>>").write.parquet(f"{tmp_path}/landed")
    args = ["--candidates", str(tmp_path / "c.csv"), "--landed", f"{tmp_path}/landed", "--output", f"{tmp_path}/out", "--history", f"{tmp_path}/hist", "--batch-size", "4", "--per-page", "2"]
    text = main(args, spark)
    judged = {r.image_url: r.disposition for r in spark.read.parquet(f"{tmp_path}/out/state").collect()}
    assert set(judged) == {f"http://h/{i}.png" for i in range(8)} | {"http://h/none.png"}
    assert judged["http://h/7.png"] == "download_failed_Timeout" and judged["http://h/none.png"] == "download_failed_NotLanded"
    assert {judged["http://h/5.png"], judged["http://h/6.png"]} <= {"accepted", "duplicate_sha1", "per_page_limit"}
    n = sum(v == "accepted" for v in judged.values())
    assert 4 <= n <= 6 and f"| accepted | {n} |" in text
    back = spark.read.option("header", True).csv(f"{tmp_path}/out/accepted")
    assert back.count() == n and set(back.select("hull_in_title").distinct().toPandas().hull_in_title) == {"True"}
    assert spark.read.parquet(f"{tmp_path}/out/split").count() == n
    assert main(args, spark).count(f"| accepted | {n} |") == 1  # resumed: nothing new


def test_discovery(spark):
    import html
    import json

    hit = lambda **x: f'<a m="{html.escape(json.dumps(x))}">'
    search = spark.createDataFrame([(hit(murl="http://h/a.jpg", purl="http://p/1", t="DDG-51") + hit(murl="http://h/old.jpg", purl="http://p/2", t=""),)], "html string")
    site = spark.createDataFrame([("http://s/index.htm", '<a href="pages/uss_1.htm">x</a>'), ("http://s/pages/uss_1.htm", '<title>One</title><img src="b.jpg">')], "url string, html string")
    titles = spark.createDataFrame([('{"query":{"search":[{"title":"File:C.jpg"}]}}',)], "body string")
    answers = spark.createDataFrame([('{"query":{"pages":{"1":{"title":"File:C.jpg","imageinfo":[{"url":"http://w/c.jpg","width":800,"height":600}]}}}}',)], "body string")
    cache = spark.createDataFrame([("bing", "", "http://h/old.jpg", "i", "", False)], "source string, page_url string, image_url string, source_id string, title string, has_hull_in_title boolean")
    got = lifecycle.discover(spark, {"bing": (search, None)}, {"navsource": (site, site.filter("url LIKE '%index.htm'").select("url"))}, (titles, answers), cache).collect()
    assert sorted((r.source, r.image_url, r.title, r.has_hull_in_title) for r in got) == [("bing", "http://h/a.jpg", "DDG-51", True), ("bing", "http://h/old.jpg", "", False), ("navsource", "http://s/pages/b.jpg", "One", False), ("wikimedia", "http://w/c.jpg", "C", False)]
