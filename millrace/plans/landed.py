"""Queries over landed files, written tables and made-up candidates, with their oracles.

What the driver's tables don't hold (tables of earlier runs, pictures, snapshots,
search answers, picture tags) is made from their rows or stands here as literals;
files are put into the shared folder and read by the library's own readers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import images, text, urls
from millrace.operators import batches, cascade, dedup, extract, select
from millrace.plans import report
from millrace.sources import readers, shared, writers
from millrace.streaming import curate, monitor

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def _query(sql: str):
    def add(f: Query) -> Query:
        _queries[f.__name__], _sql[f.__name__] = f, sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _files(spark: SparkSession, name: str, files: dict[str, str | bytes]) -> str:
    """A folder with some files."""
    root = shared.place(spark, name)
    for path, body in files.items():
        shared.put(spark, f"{root}/{path}", body if isinstance(body, bytes) else body.encode())
    return root


def _s(*parts) -> Column:
    """Strings and columns as one string."""
    return F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


def _pick(values, key: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (key % len(values) + 1).cast("int"))


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _any(column: str, values) -> str:
    return "(" + " OR ".join(f"contains({column}, '{v}')" for v in values) + ")"


# -- files that were landed -------------------------------------------------------------

_HEADER = "file_name,source,page_url,image_url,title,orig_width,orig_height,sharpness,ocr_text,ocr_conf,sha1,dhash,hull_in_title\n"
_ACCEPTED = (
    "﻿" + _HEADER + 'a.jpg,bing, http://p/1 ,http://h/a.jpg?x=1,"A ""quoted"", title\nof two lines",800,600,75.25,DDG 51,0.9876,s1,d1,True\n'
    "b.jpg,usni,,http://h/b_tn.jpg,,wide,,nan?,,,s2,,False\n"
)


@_query(
    """SELECT * FROM (VALUES ('a.jpg', 'bing', 'http://p/1', 'http://h/a.jpg?x=1', 'A "quoted", title' || chr(10) || 'of two lines', 800, 600, 75.25::DOUBLE, 'DDG 51', 0.9876::DOUBLE, 's1', 'd1', true),
('b.jpg', 'usni', '', 'http://h/b_tn.jpg', '', NULL, NULL, NULL, '', NULL, 's2', '', false)) AS t(file_name, source, page_url, image_url, title, orig_width, orig_height, sharpness, ocr_text, ocr_conf, sha1, dhash, hull_in_title)"""
)
def accepted_scan(spark, sf):
    """An accepted table with a byte order mark, quotes, line feeds and numbers that are none."""
    return readers.accepted(spark, _files(spark, "accepted", {"accepted.csv": _ACCEPTED}) + "/accepted.csv")


@_query(
    """SELECT * FROM (VALUES ('http://h/a.jpg', 'http://h/a.jpg', 'http://p/1', 's1'), ('http://h/B_TN.jpg', 'http://h/b.jpg', '', ''), ('', '', 'http://p/3', 's3')) AS t(image_url, canonical_url, page_url, sha1)"""
)
def history_scan(spark, sf):
    """Keys of all accepted tables below a folder but those of the current output and of other names."""
    row = lambda image, page, sha1: f"f,bing,{page},{image},t,1,1,1,,1,{sha1},,True\n"
    root = _files(
        spark,
        "history",
        {
            "run1/accepted.csv": _HEADER + row(" http://h/a.jpg", "http://p/1 ", "s1"),
            "deep/run2/accepted_china.csv": _HEADER + row("http://h/B_TN.jpg", "", "") + row("", "http://p/3", "s3"),
            "run3/accepted_old.csv": _HEADER + row("http://h/no.jpg", "", "s4"),
            "out/accepted.csv": _HEADER + row("http://h/own.jpg", "", "s5"),
        },
    )
    return readers.history(spark, root, exclude=f"{root}/out")


@_query("SELECT * FROM (VALUES ('processed/a.jpg', sha1('one')), ('train/images/b.png', sha1('two')), ('labeling/hard/images/c.jpg', sha1('three'))) AS t(file, sha1)")
def picture_hash_scan(spark, sf):
    """Hashes of pictures in the known folders of earlier runs; other folders, names and the output are left out."""
    files = {"run1/processed/a.jpg": "one", "run1/train/images/b.png": "two", "run2/labeling/hard/images/c.jpg": "three", "run1/other/d.jpg": "x", "run1/processed/e.gif": "y", "out/processed/f.jpg": "z", "processed/g.jpg": "w"}
    root = _files(spark, "pictures", files)
    found = readers.picture_hashes(spark, root, exclude=f"{root}/out")
    return found.select(F.regexp_extract("path", r"/run\d/(.*)$", 1).alias("file"), "sha1")


@_query(
    "SELECT *, substring(md5(image_url), 1, 16) AS source_id, true AS missing_is_none FROM (VALUES ('bing', 'http://h/a.jpg', 'http://p/1', 'A, b', true), ('usni', 'http://h/c.jpg', '', '', false)) AS t(source, image_url, page_url, title, has_hull_in_title)"
)
def candidate_scan(spark, sf):
    """A candidate cache; where there is none, the answer is none."""
    root = _files(spark, "cache", {"c.csv": 'source,image_url,page_url,title,has_hull_in_title\nbing,http://h/a.jpg,http://p/1,"A, b",True\nusni, http://h/c.jpg,,,no\n'})
    return readers.candidates(spark, f"{root}/c.csv").withColumn("missing_is_none", F.lit(readers.candidates(spark, f"{root}/none.csv") is None))


@_query("SELECT 2::BIGINT AS accepted_count, 's1,s2' AS sha1s, 3::BIGINT AS blurry, 1::BIGINT AS per_page, 'http://h/x' AS failed, '2024-01-02T03:04:05' AS last_save")
def state_scan(spark, sf):
    """A saved state; a half-written one gives no row."""
    good = '{"accepted_count": 2,\n "accepted_sha1": ["s1", "s2"], "rejection_counts": {"blurry": 3}, "accepted_page_counts": {"http://p/1": 1}, "failed_urls": ["http://h/x"], "last_save": "2024-01-02T03:04:05"}'
    root = _files(spark, "state", {"a.json": good, "b.json": good[:40]})
    return readers.state(spark, root).select(
        "accepted_count", F.array_join("accepted_sha1", ",").alias("sha1s"), F.col("rejection_counts")["blurry"].alias("blurry"), F.col("accepted_page_counts")["http://p/1"].alias("per_page"), F.array_join("failed_urls", ",").alias("failed"), "last_save"
    )


_SNAPSHOTS = [("00:00", 0), ("00:01", 3), ("00:02", 5), ("00:03", 50), ("00:04", 50), ("00:08", 50), ("00:09", 50), ("00:10", 51), ("00:16", 51)]


def _watched(spark) -> DataFrame:
    lines = [f'{{"ts": "2024-01-01T{t}:00Z", "accepted_count": {n}, "rejection_counts": {{"blurry": {n}}}}}' for t, n in _SNAPSHOTS]
    root = _files(spark, "snapshots", {"a.json": "\n".join(lines[:4]) + '\n{"ts": "2024-01', "b.json": "\n".join(lines[4:]) + "\n"})
    out, checkpoint = shared.place(spark, "followed"), shared.place(spark, "follow-checkpoint")
    monitor.watch(spark, root, out, checkpoint, "a").awaitTermination()
    return spark.read.parquet(out)


@_query(
    """SELECT * FROM (VALUES ('00:00', 0::BIGINT, NULL::BIGINT, 0, false, false), ('00:01', 3, 3, 1, false, false), ('00:02', 5, 2, 0, true, false), ('00:03', 50, 45, 0, false, false), ('00:04', 50, 0, 0, false, false),
('00:08', 50, 0, 0, false, false), ('00:09', 50, 0, 0, false, true), ('00:10', 51, 1, 1, false, false), ('00:16', 51, 0, 0, false, true)) AS t(minute, accepted_count, new_count, streak, low_yield_alert, stall_alert)"""
)
def state_stream_follow(spark, sf):
    """Snapshots that land in a folder, followed as a stream: gains, streaks and alerts."""
    return _watched(spark).select(F.date_format("ts", "HH:mm").alias("minute"), "accepted_count", "new_count", "streak", "low_yield_alert", "stall_alert")


@_query("SELECT * FROM (VALUES ('00:02', 'low_yield'), ('00:09', 'stall'), ('00:16', 'stall')) AS t(minute, alert)")
def stream_alerts(spark, sf):
    """The alerts of the followed snapshots."""
    return monitor.alerts(_watched(spark)).select(F.date_format("ts", "HH:mm").alias("minute"), "alert")


# -- sources: search answers, directories, the API ----------------------------------------

_MADE = "CASE page_id % 5 WHEN 0 THEN 'https://pics.example.org/p' || page_id || '.jpg' WHEN 1 THEN 'https://cdn.alamy.com/x' || page_id || '.jpg' WHEN 2 THEN 'https://pics.example.org/logo' || page_id || '.png' WHEN 3 THEN '' ELSE 'https://pics.example.org/uss-cv-' || page_id % 100 || '.jpg' END"
_RESULTS = f"r AS (SELECT page_id, url, {_MADE} AS image_url, 'DDG-' || page_id % 10000 || ' & co' AS title FROM pages)"


def _answers(spark, sf) -> DataFrame:
    k = F.col("page_id")
    made = (
        F.when(k % 5 == 0, _s("https://pics.example.org/p", k, ".jpg"))
        .when(k % 5 == 1, _s("https://cdn.alamy.com/x", k, ".jpg"))
        .when(k % 5 == 2, _s("https://pics.example.org/logo", k, ".png"))
        .when(k % 5 == 3, F.lit(""))
        .otherwise(_s("https://pics.example.org/uss-cv-", k % 100, ".jpg"))
    )
    q = "&quot;"
    hit = _s(f'<p><a class="iusc" m="{{{q}murl{q}:{q}', made, f"{q},{q}purl{q}:{q}", F.col("url"), f"{q},{q}t{q}:{q}DDG-", k % 10000, f' &amp; co{q}}}">one</a><a m="{{{q}murl{q}: broken}}">two</a><a m="{{{q}purl{q}:{q}x{q}}}">')
    return _t(spark, sf, "pages").select("page_id", hit.alias("html"))


@_query(f"WITH {_RESULTS} SELECT page_id, image_url, url AS page_url, title FROM r WHERE image_url <> ''")
def search_scan(spark, sf):
    """The JSON objects in search answers made from all pages: picture, page and title."""
    return extract.search_results(_answers(spark, sf)).select("page_id", "image_url", "page_url", "title")


@_query(
    f"""WITH {_RESULTS} SELECT 'bing' AS source, url AS page_url, image_url, substring(md5(image_url), 1, 16) AS source_id, title, true AS has_hull_in_title FROM r
WHERE image_url <> '' AND NOT {_any("lower(image_url)", urls.BLOCKED_DOMAINS)} AND NOT {_any("lower(url)", urls.BLOCKED_DOMAINS)} AND NOT {_any("lower(image_url)", urls.BAD_KEYWORDS)}"""
)
def search_candidates(spark, sf):
    """Candidates of search answers, without stock pictures and bad keywords."""
    return extract.search_candidates(extract.search_results(_answers(spark, sf)), "bing").drop("ord")


@_query(f"WITH {_RESULTS} SELECT 'usni' AS source, url AS page_url, image_url, substring(md5(image_url), 1, 16) AS source_id, title, true AS has_hull_in_title FROM r WHERE image_url <> '' AND contains(lower(url || image_url), 'example.org')")
def site_search_candidates(spark, sf):
    """Candidates of search answers that belong to a site."""
    return extract.search_candidates(extract.search_results(_answers(spark, sf)), "usni", "example.org").drop("ord")


_TAG_W = "CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN p_size * 20 || 'px' WHEN 2 THEN 'auto' ELSE p_size * 30 || '' END"
_TAG_H = "CASE p_partkey % 3 WHEN 0 THEN 'x' WHEN 1 THEN p_size * 7 || '' ELSE p_size * 9 || 'px' END"
_EXTENSION = "list_extract(['.jpg', '.JPEG', '.png', '.webp', '.gif', '.bmp', '.jpg?x=1'], CAST(p_partkey % 7 + 1 AS INT))"
_STEM = "list_extract(['a', 'banner', 'divider', 'map', 'uss_b'], CAST(p_partkey % 5 + 1 AS INT))"


def _directory(spark, sf) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    w = F.when(k % 4 == 0, "").when(k % 4 == 1, _s(s * 20, "px")).when(k % 4 == 2, "auto").otherwise(_s(s * 30))
    h = F.when(k % 3 == 0, "x").when(k % 3 == 1, _s(s * 7)).otherwise(_s(s * 9, "px"))
    name = _s("../i/", _pick(["a", "banner", "divider", "map", "uss_b"], k), k, _pick([".jpg", ".JPEG", ".png", ".webp", ".gif", ".bmp", ".jpg?x=1"], k))
    tag = _s("<title>Ship ", k, '</title><!-- <img src="no.jpg"> --><IMG alt="x" src="', name, '" width="', w, '" height=\'', h, "'><img alt=none>")
    return _t(spark, sf, "part").select(_s("http://ships.example.org/pages/uss_", k, ".htm").alias("url"), tag.alias("html"))


@_query(f"SELECT 'http://ships.example.org/pages/uss_' || p_partkey || '.htm' AS url, 0 AS ord, 'Ship ' || p_partkey AS title, 'http://ships.example.org/i/' || {_STEM} || p_partkey || {_EXTENSION} AS image_url, {_TAG_W} AS width, {_TAG_H} AS height FROM part")
def page_pictures(spark, sf):
    """Every picture tag of made-up pages with its declared size."""
    return extract.pictures(_directory(spark, sf)).select("url", "ord", "title", "image_url", "width", "height")


def _sites(site: str) -> str:
    return f"""SELECT '{site}' AS source, 'http://ships.example.org/pages/uss_' || p_partkey || '.htm' AS page_url, i AS image_url, substring(md5(i), 1, 16) AS source_id, false AS has_hull_in_title
FROM (SELECT p_partkey, 'http://ships.example.org/i/' || {_STEM} || p_partkey || {_EXTENSION} AS i, {_TAG_W} AS w, {_TAG_H} AS h FROM part)
WHERE regexp_matches(lower(i), '\\.({"|".join(e[1:] for e in urls.DIRECTORY_EXTENSIONS[site])})$') AND NOT {_any("lower(i)", urls.LAYOUT_WORDS[site])} AND NOT {_any("lower(i)", urls.BAD_KEYWORDS)}
AND CASE WHEN w = '' OR h = '' THEN true WHEN try_cast(replace(w, 'px', '') AS INT) IS NULL THEN true WHEN try_cast(replace(w, 'px', '') AS INT) < 250 THEN false
  WHEN try_cast(replace(h, 'px', '') AS INT) IS NULL THEN true ELSE try_cast(replace(h, 'px', '') AS INT) >= 150 END"""


@_query(_sites("navsource") + " UNION ALL " + _sites("maritimequest"))
def directory_candidates(spark, sf):
    """Candidates of both directory sites: extension, layout, keyword and size rules."""
    pages = _directory(spark, sf)
    both = extract.directory_candidates(pages, "navsource").union(extract.directory_candidates(pages, "maritimequest"))
    return both.drop("ord", "title")


_SITE = [
    ("http://s.org/index.htm", '<a href="a.htm">A</a><a href="/pages/uss_1.htm">1</a><a href="/contact.htm">c</a><a href="http://s.org/pic.jpg">p</a>'),
    ("http://s.org/a.htm", '<a href="index.htm">back</a><a href="b.html">B</a><a href="b.html">again</a>'),
    ("http://s.org/b.html", '<a href="misc_ships/x.htm">x</a><a href="gone.htm">gone</a>'),
    ("http://s.org/pages/uss_1.htm", '<title>DDG-51</title><img src="one.jpg"><img src="logo.jpg">'),
    ("http://s.org/misc_ships/x.htm", '<title>x</title><img src="two.png" width="300" height="200"><img src="three.png" width="100" height="200">'),
    ("http://s.org/contact.htm", '<a href="/pages/uss_9.htm">9</a>'),
    ("http://s.org/pages/uss_9.htm", '<img src="nine.jpg">'),
    ("http://s.org/pages/uss_7.htm", '<img src="seven.jpg">'),
]


@_query("SELECT * FROM (VALUES ('http://s.org/pages/uss_1.htm', 'http://s.org/pages/one.jpg', true), ('http://s.org/misc_ships/x.htm', 'http://s.org/misc_ships/two.png', false)) AS t(page_url, image_url, has_hull_in_title)")
def directory_crawl(spark, sf):
    """Pictures of the ship pages that an index reaches: cycles, dead links, blocked paths and pages out of reach."""
    pages = spark.createDataFrame(_SITE, "url string, html string")
    return extract.crawl(pages, pages.filter("url LIKE '%index.htm'").select("url"), "navsource").select("page_url", "image_url", "has_hull_in_title")


@_query(
    """SELECT p_partkey, 'A' || p_partkey AS title, CASE WHEN p_partkey % 2 = 0 THEN 'http://t/' || p_partkey || '.jpg' ELSE 'http://u/' || p_partkey || '.jpg' END AS image_url
FROM part WHERE p_partkey % 3 > 0 AND p_size * 40 >= 500 AND p_size * 20 >= 350"""
)
def api_scan(spark, sf):
    """Titles of API answers that name files, cleaned, with the picture that the lookup answers gave them."""
    k, s = F.col("p_partkey"), F.col("p_size")
    name = _s(F.when(k % 3 > 0, "File:").otherwise("Category:"), "A", k, ".jpg")
    found = _s('{"query":{"search":[{"title":"', name, '"},{"title":"Talk:B"}]},"continue":{"sroffset":50}}')
    thumb = F.when(k % 2 == 0, _s('"thumburl":"http://t/', k, '.jpg",')).otherwise('"thumburl":"",')
    looked = _s('{"query":{"pages":{"-1":{"title":"File:none.jpg"},"7":{"title":"File:A', k, '.jpg","imageinfo":[{', thumb, '"url":"http://u/', k, '.jpg","width":', s * 40, ',"height":', s * 20, "}]}}}}")
    part = _t(spark, sf, "part")
    titles = extract.api_titles(part.select("p_partkey", found.alias("body"))).drop("ord")
    pictures = extract.api_pictures(part.select(looked.alias("body")))
    return extract.lookup(titles, pictures).select("p_partkey", text.clean_title(F.col("title")).alias("title"), "image_url")


# -- sinks, read back ---------------------------------------------------------------------


@_query("SELECT CAST(doc_id % 3 + 1 AS INT) AS batch, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM documents GROUP BY 1")
def accepted_append(spark, sf):
    """Batches of accepted rows appended to a table; one that is run again replaces itself."""
    path, rows = shared.place(spark, "appended"), _t(spark, sf, "documents").select("doc_id")
    for b in (1, 2, 3, 2):
        writers.append_batch(rows.filter(F.col("doc_id") % 3 + 1 == b), path, b)
    return spark.read.parquet(path).groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


@_query("SELECT 'bing' AS source, url AS page_url, url || '/x.jpg' AS image_url, substring(md5(url || '/x.jpg'), 1, 16) AS source_id, 'a \"b\", ' || page_id AS title, page_id % 2 = 0 AS has_hull_in_title FROM pages")
def candidate_export(spark, sf):
    """Candidates written as CSV and read by the cache's reader."""
    k = F.col("page_id")
    rows = _t(spark, sf, "pages").select(F.lit("bing").alias("source"), _s(F.col("url"), "/x.jpg").alias("image_url"), F.col("url").alias("page_url"), _s('a "b", ', k).alias("title"), F.initcap((k % 2 == 0).cast("string")).alias("has_hull_in_title"))
    path = shared.place(spark, "candidates")
    writers.export_csv(rows, path)
    return readers.candidates(spark, path)


_ROW = """SELECT p_partkey, 'bi_' || substring(md5(CAST(p_partkey AS VARCHAR)), 1, 16) || '_' || CASE WHEN trim(regexp_replace(lower(substring(p_name, 1, 25)), '[^\\p{L}\\p{N}]', '_', 'g'), '_') = '' THEN 'bing' ELSE trim(regexp_replace(lower(substring(p_name, 1, 25)), '[^\\p{L}\\p{N}]', '_', 'g'), '_') END || '.jpg' AS file_name,
  p_name AS title, CAST(p_size * 20 AS INT) AS orig_width, round(p_retailprice / 7, 2) AS sharpness, substring(repeat(p_type || ' ', 9), 1, 100) AS ocr_text, round(1 / (p_size + 1.0::DOUBLE), 4) AS ocr_conf, CASE WHEN p_partkey % 2 = 0 THEN 'True' ELSE 'False' END AS hull_in_title FROM part"""


def _accepted_rows(spark, sf) -> DataFrame:
    k = F.col("p_partkey")
    rows = _t(spark, sf, "part").select(
        k, F.lit("bing").alias("source"), F.substring(F.md5(k.cast("string").cast("binary")), 1, 16).alias("source_id"), F.col("p_name").alias("title"), F.lit("http://p").alias("page_url"), F.lit("http://h/a.jpg").alias("image_url"),
        (F.col("p_size") * 20).alias("w"), F.lit(600).alias("h"), (F.col("p_retailprice") / 7).alias("sharpness"), F.repeat(_s(F.col("p_type"), " "), 9).alias("ocr_text"), (1 / (F.col("p_size") + F.lit(1.0))).alias("ocr_conf"),
        F.lit("s").alias("sha1"), F.lit("d").alias("dhash"), (k % 2 == 0).alias("has_hull_in_title"),
    )
    stem = text.file_stem(F.col("source"), F.col("source_id"), F.col("title"))
    return rows.select("p_partkey", *writers.accepted_row(F.col("source"), F.col("source_id"), stem))


@_query(_ROW)
def accepted_rows(spark, sf):
    """Accepted rows of made-up candidates: names, rounding and truncation."""
    return _accepted_rows(spark, sf).select("p_partkey", "file_name", "title", "orig_width", "sharpness", "ocr_text", "ocr_conf", "hull_in_title")


@_query(f"SELECT file_name, title, trim(ocr_text) AS ocr_text, hull_in_title FROM ({_ROW}) ORDER BY md5('42:' || file_name), file_name LIMIT 30")
def review_export(spark, sf):
    """The review sample, written as CSV and read back."""
    path = shared.place(spark, "review")
    writers.export_review(select.sample(_accepted_rows(spark, sf), F.col("file_name"), 30), path)
    return spark.read.option("header", True).option("escape", '"').csv(path).select("file_name", "title", "ocr_text", "hull_in_title")


def _judged(spark, sf) -> DataFrame:
    """Documents as judged candidates."""
    k = F.col("doc_id")
    verdict = F.when(k % 4 == 0, "accepted").when(k % 4 == 1, "no_digits_or_too_long").when(k % 8 == 2, "download_failed_Timeout").when(k % 8 == 6, "blurry").otherwise("quota_dropped")
    return _t(spark, sf, "documents").select(
        "doc_id", verdict.alias("disposition"), ((k % 3 == 0) & (k % 4 != 1)).alias("fast_path"), (k % 4 != 1).alias("ocr_ok"), _s("s", k % 7).alias("sha1"), F.when(k % 5 == 0, "").otherwise(_s("d", k % 5)).alias("dhash"), _s("http://p/", k % 3).alias("page_url"), _s("http://h/", k % 11).alias("image_url")
    )


_JUDGED = """j AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'accepted' WHEN doc_id % 4 = 1 THEN 'no_digits_or_too_long' WHEN doc_id % 8 = 2 THEN 'download_failed_Timeout' WHEN doc_id % 8 = 6 THEN 'blurry' ELSE 'quota_dropped' END AS d, doc_id % 3 = 0 AS fast, doc_id % 4 <> 1 AS ok FROM documents),
c AS (SELECT count(*) AS total, count(*) FILTER (WHERE d = 'accepted') AS accepted, count(*) FILTER (WHERE ok AND d IN ('accepted', 'quota_dropped')) AS passed, count(*) FILTER (WHERE NOT ok) AS failed, count(*) FILTER (WHERE ok AND fast AND d IN ('accepted', 'quota_dropped')) AS fast FROM j)"""


@_query(f"WITH {_JUDGED} SELECT total AS total_candidates, accepted, passed AS ocr_passed, failed AS ocr_failed, fast AS metadata_fast_path, CAST(CASE WHEN passed > 0 THEN round(fast * 100.0 / passed, 1) ELSE 0.0 END AS DOUBLE) AS metadata_pct, CAST(round(accepted / 0.5, 1) AS DOUBLE) AS accepted_per_hour FROM c")
def ocr_counters(spark, sf):
    """Rows that reached the text rule: passed, failed, passed by their metadata."""
    return report.report(_judged(spark, sf), 5000, 1800.0).select("total_candidates", "accepted", "ocr_passed", "ocr_failed", "metadata_fast_path", "metadata_pct", "accepted_per_hour")


@_query(f"WITH {_JUDGED} SELECT total AS total_candidates, 5000 - accepted AS remaining_to_target, 1800.0::DOUBLE AS duration_sec, (SELECT string_agg(d || '=' || n, ',' ORDER BY n DESC, d) FROM (SELECT d, count(*) AS n FROM j WHERE d <> 'accepted' GROUP BY 1)) AS top FROM c")
def report_export(spark, sf):
    """The report written as JSON and read back."""
    path = shared.place(spark, "report")
    writers.export_json(report.report(_judged(spark, sf), 5000, 1800.0), path)
    back = spark.read.schema("total_candidates bigint, remaining_to_target bigint, duration_sec double, rejection_top array<struct<reason:string,n:bigint>>").json(path)
    return back.select("total_candidates", "remaining_to_target", "duration_sec", F.array_join(F.transform("rejection_top", lambda x: F.concat(x["reason"], F.lit("="), x["n"].cast("string"))), ",").alias("top"))


@_query(
    f"""WITH {_JUDGED} SELECT unnest(['# Run report', 'Made at 2024-01-02T03:04:05', '| total_candidates | ' || total || ' |', '| accepted | ' || accepted || ' |', '| remaining_to_target | ' || (5000 - accepted) || ' |']) AS line FROM c
UNION ALL SELECT '| ' || d || ' | ' || count(*) || ' |' FROM j WHERE d <> 'accepted' GROUP BY d"""
)
def report_markdown(spark, sf):
    """Lines of the report's Markdown: heading, time stamp, some counters and the reasons."""
    rows = report.report(_judged(spark, sf), 5000, 1800.0).withColumn("at", report.stamp(F.lit("2024-01-02 03:04:05").cast("timestamp")))
    row = rows.first()
    told = {"# Run report", f"Made at {row.at}", *(f"| {k} | {row[k]} |" for k in ("total_candidates", "accepted", "remaining_to_target")), *(f"| {r.reason} | {r.n} |" for r in row.rejection_top)}
    lines = report.markdown(row, row.at).splitlines()
    return spark.createDataFrame([(x,) for x in lines if x in told], "line string")


@_query(
    """SELECT count(*) FILTER (WHERE doc_id % 4 = 0) AS accepted_count, string_agg(DISTINCT CASE WHEN doc_id % 4 = 0 THEN 's' || doc_id % 7 END, ',' ORDER BY CASE WHEN doc_id % 4 = 0 THEN 's' || doc_id % 7 END) AS sha1s, string_agg(DISTINCT CASE WHEN doc_id % 4 = 0 AND doc_id % 5 > 0 THEN 'd' || doc_id % 5 END, ',' ORDER BY CASE WHEN doc_id % 4 = 0 AND doc_id % 5 > 0 THEN 'd' || doc_id % 5 END) AS dhashes,
count(*) FILTER (WHERE doc_id % 8 = 6) AS blurry, count(*) FILTER (WHERE doc_id % 4 = 0 AND doc_id % 3 = 0) AS fast, count(*) FILTER (WHERE doc_id % 4 = 0 AND doc_id % 3 = 1) AS page1,
string_agg(DISTINCT CASE WHEN doc_id % 8 = 2 THEN 'http://h/' || doc_id % 11 END, ',' ORDER BY CASE WHEN doc_id % 8 = 2 THEN 'http://h/' || doc_id % 11 END) AS failed, '2024-01-02T03:04:05' AS last_save FROM documents"""
)
def state_export(spark, sf):
    """The state written as JSON, keys sorted and time stamped, and read back."""
    path = shared.place(spark, "state-out")
    writers.export_json(report.state(_judged(spark, sf), F.lit("2024-01-02 03:04:05").cast("timestamp")), path)
    got = readers.state(spark, path)
    return got.select(
        "accepted_count", F.array_join("accepted_sha1", ",").alias("sha1s"), F.array_join("accepted_dhash", ",").alias("dhashes"), F.col("rejection_counts")["blurry"].alias("blurry"), F.col("ocr_stats")["fast_path"].alias("fast"),
        F.col("accepted_page_counts")["http://p/1"].alias("page1"), F.array_join("failed_urls", ",").alias("failed"), "last_save",
    )


@_query("WITH s AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= greatest(1, CAST(floor((SELECT count(*) FROM documents) * 0.85) AS BIGINT)) AS train FROM documents) SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS split, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids, 'hull_number' AS classes FROM s GROUP BY 1")
def split_folders(spark, sf):
    """The split written as folders, with the class file beside them, and read back."""
    path = shared.place(spark, "split")
    writers.export_split(select.split(_t(spark, sf, "documents").select("doc_id"), F.col("doc_id")), path)
    for name, body in writers.class_files(path).items():
        shared.put(spark, f"{path}-files/{name}", body.encode())
    classes = spark.read.text(f"{path}-files/classes.txt").first()[0]
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids")).withColumn("classes", F.lit(classes))


@_query("SELECT * FROM (VALUES ('processed/a.jpg', 2), ('raw/a.png', 2), ('raw/b.txt', 2)) AS t(file, removed)")
def orphan_removal(spark, sf):
    """Files that no accepted row names are removed, with their raws; what is left."""
    root = _files(spark, "orphans", {"processed/a.jpg": "1", "processed/b.jpg": "2", "raw/a.png": "3", "raw/b.webp": "4", "raw/b.txt": "5"})
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"))
    listed = shared.written(listed, "listed")
    gone = dedup.orphans(listed.filter("folder = 'processed'"), spark.createDataFrame([("a.jpg",)], "file_name string"))
    raws = dedup.orphan_raws(gone, listed.filter("folder = 'raw'"))
    removed = shared.remove(spark, [r.path for r in gone.union(raws).select("path").collect()])  # the files of one output folder
    left = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return left.select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("file"), F.lit(removed).alias("removed"))


# -- rules on made-up candidates -----------------------------------------------------------

_RULE_WORDS = [*urls.BLOCKED_DOMAINS, *urls.BAD_KEYWORDS, *urls.LAYOUT_WORDS["navsource"], *urls.BLOCKED_PATHS["navsource"], *urls.BLOCKED_PATHS["maritimequest"], *urls.INDEX_PAGE_MARKS, "ship", "Photo", "uss_1"]
_ENDINGS = [".jpg", ".JPEG", ".png", ".webp", ".gif", ".bmp", ".htm", ".HTML", ".jpg?w=1", ""]
_RULE_URL = f"'http://X.example.net/' || CASE WHEN p_partkey % 2 = 0 THEN upper(w) ELSE w END || '/' || p_partkey || e"


@_query(
    f"""WITH u AS (SELECT p_partkey, list_extract({_list(_RULE_WORDS)}, CAST(p_partkey % {len(_RULE_WORDS)} + 1 AS INT)) AS w, list_extract({_list(_ENDINGS)}, CAST(p_partkey % {len(_ENDINGS)} + 1 AS INT)) AS e FROM part), l AS (SELECT p_partkey, lower({_RULE_URL}) AS l FROM u)
SELECT p_partkey, {_any("l", urls.BLOCKED_DOMAINS)} AS blocked, {_any("l", urls.BAD_KEYWORDS)} AS bad, {_any("l", urls.BLOCKED_PATHS["navsource"])} AS path_ns, {_any("l", urls.BLOCKED_PATHS["maritimequest"])} AS path_mq,
  regexp_matches(l, '\\.(jpg|jpeg|png|webp|gif)$') AS picture_ns, regexp_matches(l, '\\.(jpg|jpeg|png|webp)$') AS picture_mq, {_any("l", urls.LAYOUT_WORDS["navsource"])} AS layout_ns, {_any("l", urls.LAYOUT_WORDS["maritimequest"])} AS layout_mq,
  regexp_matches(l, '\\.html?$') AS html_page, {_any("l", urls.INDEX_PAGE_MARKS)} AS index_page, contains(l, 'example.net') AS of_domain FROM l"""
)
def url_rules(spark, sf):
    """Every URL rule on made-up URLs that hit each of its words, in both cases."""
    k = F.col("p_partkey")
    word = _pick(_RULE_WORDS, k)
    u = F.col("u")
    rows = _t(spark, sf, "part").select(k, _s("http://X.example.net/", F.when(k % 2 == 0, F.upper(word)).otherwise(word), "/", k, _pick(_ENDINGS, k)).alias("u"))
    pairs = {"picture": urls.has_picture_extension, "layout": urls.is_layout_picture, "path": urls.is_blocked_path}
    both = [f(u, site).alias(f"{name}_{short}") for name, f in pairs.items() for site, short in (("navsource", "ns"), ("maritimequest", "mq"))]
    return rows.select("p_partkey", urls.is_blocked_domain(u).alias("blocked"), urls.is_bad_keyword(u).alias("bad"), *both, urls.is_html_page(u).alias("html_page"), urls.is_index_page(u).alias("index_page"), urls.has_domain("example.net", u).alias("of_domain"))


_DESCRIPTORS = """x AS (SELECT l_orderkey, l_linenumber, l_orderkey % 11 AS a, l_orderkey % 13 AS b, l_orderkey % 7 AS c, l_orderkey % 17 AS d, l_orderkey % 5 AS e FROM lineitem)"""


@_query(
    f"""WITH {_DESCRIPTORS} SELECT l_orderkey, l_linenumber, CASE WHEN a = 1 THEN 'non_image_content_type' WHEN a = 2 THEN 'download_failed_Timeout' WHEN b = 1 THEN 'download_failed_ValueError' WHEN b = 2 THEN 'too_small_file'
WHEN c = 5 OR c = 6 THEN 'invalid_format' WHEN d = 1 THEN 'duplicate_sha1' WHEN d = 2 THEN 'corrupt_image' WHEN d = 3 OR d = 4 THEN 'too_small_dims' WHEN e = 1 THEN 'blurry' WHEN e = 2 THEN 'near_duplicate' ELSE 'accepted' END AS disposition FROM x"""
)
def descriptor_cascade(spark, sf):
    """The library's descriptor rules on made-up descriptors, on both sides of every threshold."""
    k = F.col("l_orderkey")
    a, b, c, d, e = (k % n for n in (11, 13, 7, 17, 5))
    rows = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(a == 1, "Text/html").when(a == 3, "").when(a == 4, None).otherwise("IMAGE/jpeg").alias("content_type"),
        F.when(a == 2, "Timeout").otherwise("").alias("error_type"),
        F.when(b == 1, 25 * 1024 * 1024 + 1).when(b == 2, 10_239).when(b == 3, 10_240).otherwise(25 * 1024 * 1024).cast("long").alias("n_bytes"),
        F.when(c == 5, "gif").when(c == 6, None).otherwise(_pick(images.FORMATS, c)).alias("img_type"),
        (d == 1).alias("known_sha1"), F.when(d == 2, None).when(d == 3, 499).otherwise(500).alias("w"), F.when(d == 4, 349).otherwise(350).alias("h"),
        F.when(e == 1, 59.99).otherwise(60.0).alias("sharpness"), (e == 2).alias("near_known"),
    )
    return rows.select("l_orderkey", "l_linenumber", cascade.disposition(cascade.descriptor_rules()).alias("disposition"))


@_query(
    """SELECT c_custkey, c_custkey % 4 <= 2 AS fast_path, c_custkey % 4 <= 2 OR c_custkey % 3 = 1 AS ocr_ok, CASE WHEN c_custkey % 4 <= 2 THEN '[metadata_hull_match]' WHEN c_custkey % 3 = 0 THEN 'none' WHEN c_custkey % 3 = 1 THEN '51 ab' ELSE 'a long text of words 51' END AS ocr_text,
CAST(CASE WHEN c_custkey % 4 <= 2 THEN 1.0 WHEN c_custkey % 3 = 0 THEN 0.0 ELSE 0.75 END AS DOUBLE) AS ocr_conf FROM customer"""
)
def fast_path_rows(spark, sf):
    """Rows whose title or URLs name a hull pass at once; the others are judged by their own tokens."""
    k = F.col("c_custkey")
    token = lambda t, c: F.struct(F.lit(t).alias("text"), F.lit(c).alias("conf"))
    rows = _t(spark, sf, "customer").select(
        "c_custkey", (k % 4 == 0).alias("has_hull_in_title"), F.when(k % 4 == 1, "http://h/ddg-51.jpg").otherwise("http://h/x.jpg").alias("image_url"), F.when(k % 4 == 2, "http://p/CVN 68").otherwise("http://p/").alias("page_url"),
        F.when(k % 3 == 0, F.array(token("none", 0.0))).when(k % 3 == 1, F.array(token("51", 0.5), token("www.navsource.org", 0.2), token("ab", 0.75), token("1234567", 0.1))).otherwise(F.array(token("a long text of words 51", 0.75))).alias("tokens"),
    )
    return cascade.fast_path(rows).select("c_custkey", "fast_path", "ocr_ok", "ocr_text", "ocr_conf")


@_query("SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'bi' WHEN 1 THEN 'un' WHEN 2 THEN 'mq' WHEN 3 THEN 'wk' WHEN 4 THEN 'ns' ELSE 'xx' END AS prefix, CASE s_suppkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 0 WHEN 3 THEN 4 WHEN 4 THEN 3 ELSE 9 END AS rank, 'S ' || s_suppkey AS cleaned, s_suppkey % 2 = 0 AS is_file FROM supplier")
def source_names(spark, sf):
    """Prefix and rank of every source, titles without their file marks."""
    k = F.col("s_suppkey")
    source = _pick(["bing", "usni", "maritimequest", "wikimedia", "navsource", "elsewhere"], k)
    title = _s(F.when(k % 2 == 0, "File:").otherwise(""), "S ", k, _pick([".jpg", ".png", ""], k))
    return _t(spark, sf, "supplier").select("s_suppkey", text.source_prefix(source).alias("prefix"), text.source_rank(source).alias("rank"), text.clean_title(title).alias("cleaned"), text.is_file_title(title).alias("is_file"))


def _urls_of(spark, sf, table: str, key: str, source: str, by: int) -> DataFrame:
    k = F.col(key)
    return _t(spark, sf, table).select(k.alias("k"), F.lit(source).alias("source"), _s("http://h/", k % by, ".jpg").alias("image_url"))


@_query("SELECT k, source, image_url FROM (SELECT c_custkey AS k, 'bing' AS source, 'http://h/' || c_custkey % 60 || '.jpg' AS image_url FROM customer) UNION ALL SELECT min(s_suppkey), 'usni', u FROM (SELECT s_suppkey, 'http://h/' || s_suppkey % 90 || '.jpg' AS u FROM supplier) WHERE u NOT IN (SELECT 'http://h/' || c_custkey % 60 || '.jpg' FROM customer) GROUP BY u")
def cache_merge(spark, sf):
    """The cached candidates and the newly found ones that it doesn't have, each once."""
    return dedup.merge_new(_urls_of(spark, sf, "customer", "c_custkey", "bing", 60), _urls_of(spark, sf, "supplier", "s_suppkey", "usni", 90), ["k"])


@_query("SELECT c_custkey AS k FROM customer WHERE c_custkey % 1000 NOT IN (SELECT s_suppkey % 1000 FROM supplier) AND c_custkey % 1000 NOT IN (SELECT n_nationkey + 200 FROM nation)")
def pending_rows(spark, sf):
    """Candidates that were neither accepted nor failed."""
    failed = _t(spark, sf, "nation").select(_s("http://h/", F.col("n_nationkey") + 200, ".jpg").alias("image_url"))
    return dedup.pending(_urls_of(spark, sf, "customer", "c_custkey", "bing", 1000), _urls_of(spark, sf, "supplier", "s_suppkey", "usni", 1000), failed).select("k")


# -- the batch loop -------------------------------------------------------------------------


def _good(spark, sf) -> DataFrame:
    """Nations as candidates that pass every rule but those of state: pages are regions, contents come twice."""
    k = F.col("n_nationkey")
    return _t(spark, sf, "nation").select(
        (k + 1).cast("long").alias("ord"), F.lit("bing").alias("source"), _s("p", F.col("n_regionkey")).alias("page_url"), _s("http://h/", k, ".jpg").alias("image_url"), F.lit("").alias("title"), F.lit(True).alias("has_hull_in_title"),
        _s("s", k % 20).alias("sha1"), F.lit("").alias("dhash"), k.cast("long").alias("bits"), F.array(F.struct(F.lit("51").alias("text"), F.lit(0.5).alias("conf"))).alias("tokens"), F.lit("image/jpeg").alias("content_type"),
        F.lit("").alias("error_type"), F.lit(20_000).cast("long").alias("n_bytes"), F.lit("jpeg").alias("img_type"), F.lit(800).alias("w"), F.lit(600).alias("h"), F.lit(99.0).alias("sharpness"),
    )


#: Of a page at most three, of two equal contents the first; no page's third place depends on a copy here.
_STRICT = """WITH u AS (SELECT n_nationkey, n_regionkey, n_nationkey >= 20 AS copy FROM nation), r AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey, copy ORDER BY n_nationkey) AS i FROM u)
SELECT CAST(n_nationkey + 1 AS BIGINT) AS ord, CASE WHEN NOT copy AND i <= 3 THEN 'accepted' WHEN NOT copy THEN 'per_page_limit' WHEN (SELECT count(*) FROM r s WHERE s.n_regionkey = r.n_regionkey AND NOT s.copy) >= 3 THEN 'per_page_limit' ELSE 'other' END AS disposition FROM r"""


@_query(_STRICT + " WHERE n_nationkey < 24")
def batch_loop(spark, sf):
    """Three batches of eight, stopped after two and resumed: caps and contents hold over batches and restarts."""
    state = shared.place(spark, "loop")
    known = spark.createDataFrame([], "sha1 string")
    for most in (2, 1):
        out = batches.run(spark, _good(spark, sf), known, limits=batches.Limits(batch_size=8, max_batches=most), mode="strict", state=state)
    return out.select("ord", "disposition")


@_query(_STRICT)
def batch_stream(spark, sf):
    """The same rules over a stream of landed candidates."""
    source, state, checkpoint = (shared.place(spark, n) for n in ("candidates-in", "stream-state", "stream-checkpoint"))
    rows = _good(spark, sf)
    rows.coalesce(1).write.parquet(source)
    curate.curate(spark.readStream.schema(rows.schema).parquet(source), spark.createDataFrame([], "sha1 string"), state, checkpoint).awaitTermination()
    return spark.read.parquet(state).select("ord", "disposition")


# -- pixels ------------------------------------------------------------------------------------

_BMP = "424D5A0000000000000036000000280000000300000003000000010018000000000024000000130B0000130B00000000000000000000"


def _pictures(spark, sf) -> DataFrame:
    """A bitmap of three by three for each nation: black with a grey centre; every fifth is cut off."""
    k = F.col("n_nationkey")
    v = F.lpad(F.hex(k * 10), 2, "0")
    content = F.unhex(_s(_BMP, "00" * 12, "000000", v, v, v, "000000", "000000", "00" * 12))
    return _t(spark, sf, "nation").select("n_nationkey", F.when(k % 5 == 4, F.substring(content, 1, 40)).otherwise(content).alias("content"))


@_query("SELECT n_nationkey, CASE WHEN n_nationkey % 5 < 4 THEN 3 END AS w, CASE WHEN n_nationkey % 5 < 4 THEN 3 END AS h, CAST(CASE WHEN n_nationkey % 5 < 4 THEN round(272.0::DOUBLE / 81 * (n_nationkey * 10) * (n_nationkey * 10), 4) ELSE 0.0 END AS DOUBLE) AS sharpness FROM nation")
def picture_pixels(spark, sf):
    """Size and sharpness of small bitmaps, decoded; what can't be read has none."""
    return _pictures(spark, sf).select("n_nationkey", images.descriptors(F.col("content")).alias("d")).select("n_nationkey", "d.w", "d.h", F.round("d.sharpness", 4).alias("sharpness"))


@_query("SELECT n_nationkey, n_nationkey % 5 < 4 AS made, CASE WHEN n_nationkey % 5 < 4 THEN 1024 END AS w, CASE WHEN n_nationkey % 5 < 4 THEN 768 END AS h, CASE WHEN n_nationkey % 5 < 4 THEN 'png' END AS format FROM nation")
def picture_normalised(spark, sf):
    """The same bitmaps scaled and centred on black."""
    made = _pictures(spark, sf).select("n_nationkey", images.normalised(F.col("content")).alias("c"))
    return made.select("n_nationkey", F.col("c").isNotNull().alias("made"), images.descriptors(F.col("c")).alias("d"), images.sniff(F.col("c")).alias("format")).select("n_nationkey", "made", "d.w", "d.h", "format")
