"""The library's queries, each with its DuckDB oracle where SQL can express it.

The tables hold no pictures, so picture rules are applied to like columns: a
page or document is a candidate, a source or host its page, a text its content.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import images, text, urls
from millrace.operators import cascade, dedup, extract, graph, select
from millrace.plans import report
from millrace.streaming import monitor

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    from millrace.plans import landed

    return _queries | landed.queries()


def oracle_sql() -> dict[str, str]:
    from millrace.plans import landed

    return _sql | landed.oracle_sql()


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- pages, links, URLs ------------------------------------------------------

_HOST = r"lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#]*)', 1))"
_LINKS = r"""quiet AS (SELECT page_id, url, regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g') AS q FROM pages),
tags AS (SELECT page_id, url, unnest(list_transform(range(1, len(l) + 1), lambda i: {'i': i, 't': l[i]})) AS x FROM (SELECT page_id, url, regexp_extract_all(q, '(?is)(<a\s[^>]*>)', 1) AS l FROM quiet)),
links AS (SELECT page_id, url, x.i - 1 AS ord, trim(replace(regexp_extract(x.t, '(?is)\shref\s*=\s*"([^"]*)"', 1), '&amp;', '&')) AS href FROM tags),
resolved AS (SELECT *, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN href
  WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) || href END AS absolute FROM links WHERE href <> '')"""
_STRIP = r"regexp_replace(regexp_replace({0}, '(?s)[?#].*$', ''), '(?s);[^/]*$', '')"


def _page_links(spark, sf):
    return extract.links(_t(spark, sf, "pages"))


@_query(f"WITH {_LINKS} SELECT page_id, CAST(ord AS INT) AS ord, href, absolute FROM resolved")
def page_links(spark, sf):
    """Every link of every page, resolved."""
    return _page_links(spark, sf).select("page_id", "ord", "href", "absolute")


@_query(
    f"""WITH {_LINKS}, c AS (SELECT page_id, ord, {_STRIP.format("absolute")} AS u FROM resolved),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY page_id, ord) AS r FROM c) WHERE r = 1),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY ord) AS p FROM f) WHERE p <= 3)
SELECT {_HOST.format("u")} AS host, count(*) AS n_links FROM k GROUP BY 1"""
)
def link_hosts(spark, sf):
    """Links, canonical, first seen anywhere, at most three a page, counted by host."""
    rows = _page_links(spark, sf).select("page_id", "ord", urls.canonical(F.col("absolute")).alias("link"))
    kept = select.cap(dedup.first_seen(rows, ["link"], ["page_id", "ord"]), ["page_id"], [F.col("ord")], 3)
    return kept.groupBy(urls.host(F.col("link")).alias("host")).agg(F.count(F.lit(1)).alias("n_links"))


@_query(f"SELECT page_id, {_STRIP.format('url')} AS canonical, substring(md5(url), 1, 16) AS source_id FROM pages")
def url_canonical(spark, sf):
    """Canonical URL and source id of every page."""
    return _t(spark, sf, "pages").select("page_id", urls.canonical(F.col("url")).alias("canonical"), urls.source_id(F.col("url")).alias("source_id"))


@_query(
    r"""WITH u AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN regexp_replace(url, '[?#].*$', '') || '/A_TN.JPG;x=1?s=_small.' WHEN 1 THEN 'HTTP://Pics.example.org/b_small.c_small.png#f' WHEN 2 THEN url || '-thumb.gif' ELSE 'x/y;p/z;q' END AS u FROM pages),
s AS (SELECT page_id, regexp_replace(regexp_replace(CASE WHEN u LIKE 'HTTP:%' THEN 'http:' || substring(u, 6) ELSE u END, '(?s)[?#].*$', ''), '(?s);[^/]*$', '') AS c FROM u)
SELECT page_id, CASE WHEN contains(lower(c), '_tn.') THEN replace(lower(c), '_tn.', '.') WHEN contains(lower(c), '-tn.') THEN replace(lower(c), '-tn.', '.')
  WHEN contains(lower(c), '_small.') THEN replace(lower(c), '_small.', '.') WHEN contains(lower(c), '-small.') THEN replace(lower(c), '-small.', '.')
  WHEN contains(lower(c), '_thumb.') THEN replace(lower(c), '_thumb.', '.') WHEN contains(lower(c), '-thumb.') THEN replace(lower(c), '-thumb.', '.') ELSE c END AS canonical FROM s"""
)
def url_thumbnails(spark, sf):
    """Canonical form of URLs with thumbnail marks, made from page URLs."""
    u, k = F.col("url"), F.col("page_id") % 4
    made = (
        F.when(k == 0, F.concat(F.regexp_replace(u, "[?#].*$", ""), F.lit("/A_TN.JPG;x=1?s=_small.")))
        .when(k == 1, "HTTP://Pics.example.org/b_small.c_small.png#f")
        .when(k == 2, F.concat(u, F.lit("-thumb.gif")))
        .otherwise("x/y;p/z;q")
    )
    return _t(spark, sf, "pages").select("page_id", urls.canonical(made).alias("canonical"))


@_query(r"SELECT doc_id, md5(replace(url_encode(text), '%2F', '/')) AS encoded_md5, length(replace(url_encode(text), '%2F', '/')) AS n_chars FROM documents")
def percent_encoded(spark, sf):
    """Percent-encoded texts, by their hash and length."""
    encoded = _t(spark, sf, "documents").select("doc_id", urls.percent_encode(F.col("text")).alias("e"))
    return encoded.select("doc_id", F.md5(F.col("e").cast("binary")).alias("encoded_md5"), F.length("e").cast("long").alias("n_chars"))


@_query(f"SELECT {_HOST.format('url')} AS host, count(*) AS n FROM pages GROUP BY 1")
def host_counts(spark, sf):
    """Pages by host."""
    return _t(spark, sf, "pages").groupBy(urls.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


@_query(f"SELECT {_HOST.format('url')} AS host, count(*) AS n FROM pages GROUP BY 1 ORDER BY n DESC, host LIMIT 5")
def host_topk(spark, sf):
    """The five hosts with most pages."""
    return report.top(host_counts(spark, sf), 5, "host")


@_query(f"SELECT page_id, host FROM (SELECT page_id, {_HOST.format('url')} AS host, row_number() OVER (PARTITION BY {_HOST.format('url')} ORDER BY page_id) AS r FROM pages) WHERE r <= 3")
def per_host_cap3(spark, sf):
    """The first three pages of each host."""
    return select.cap(_t(spark, sf, "pages").select("page_id", urls.host(F.col("url")).alias("host")), ["host"], [F.col("page_id")], 3)


@_query(f"WITH {_LINKS} SELECT page_id, CAST(ord AS INT) AS ord, absolute FROM (SELECT *, row_number() OVER (PARTITION BY absolute ORDER BY page_id, ord) AS r FROM resolved) WHERE r = 1")
def first_seen_links(spark, sf):
    """Every link where it is seen first."""
    return dedup.first_seen(_page_links(spark, sf).select("page_id", "ord", "absolute"), ["absolute"], ["page_id", "ord"])


@_query(r"SELECT page_id, replace(replace(replace(replace(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title\s*>', 1), '\s+', ' ', 'g')), '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS title FROM pages".replace('\\"', '"'))
def page_title(spark, sf):
    """Titles, white space collapsed, references decoded."""
    return _t(spark, sf, "pages").select("page_id", extract.page_title(F.col("html")).alias("title"))


@_query(r"SELECT doc_id, trim(regexp_replace(lower(substring(text, 1, 25)), '[^\p{L}\p{N}]', '_', 'g'), '_') AS stem FROM documents")
def safe_stems(spark, sf):
    """File stems from the beginnings of texts."""
    return _t(spark, sf, "documents").select("doc_id", text.safe_stem(F.col("text")).alias("stem"))


_BLOCKED = " OR ".join(f"contains(lower(url), '{d}')" for d in urls.BLOCKED_DOMAINS)
_BAD = " OR ".join(f"contains(lower(url), '{d}')" for d in urls.BAD_KEYWORDS)
_MQ = " OR ".join(f"contains(lower(url), '{d}')" for d in urls.BLOCKED_PATHS["maritimequest"])


@_query(
    f"""SELECT page_id, {_BLOCKED} AS blocked, {_BAD} AS bad, {_MQ} AS blocked_path, contains(lower(url), 'example.com') AS of_domain,
  regexp_matches(lower(url), '\\.(jpg|jpeg|png|webp|gif)$') AS picture,
  ({" OR ".join(f"contains(lower(url), '{w}')" for w in urls.LAYOUT_WORDS["navsource"])}) AS layout,
  regexp_matches(lower(url), '\\.html?$') AS html_page, ({" OR ".join(f"contains(lower(url), '{w}')" for w in urls.INDEX_PAGE_MARKS)}) AS index_page FROM pages"""
)
def url_flags(spark, sf):
    """Every URL rule on every page's URL."""
    u = F.col("url")
    return _t(spark, sf, "pages").select(
        "page_id",
        urls.is_blocked_domain(u).alias("blocked"),
        urls.is_bad_keyword(u).alias("bad"),
        urls.is_blocked_path(u, "maritimequest").alias("blocked_path"),
        urls.has_domain("example.com", u).alias("of_domain"),
        urls.has_picture_extension(u, "navsource").alias("picture"),
        urls.is_layout_picture(u, "navsource").alias("layout"),
        urls.is_html_page(u).alias("html_page"),
        urls.is_index_page(u).alias("index_page"),
    )


_SHIP_U = "'http://ships.example.org/' || CASE p_partkey % 6 WHEN 0 THEN 'pages/uss_' || p_partkey || '.htm' WHEN 1 THEN 'archives/05/0' || p_partkey || '.html' WHEN 2 THEN 'main_page_' || p_partkey || '.htm' WHEN 3 THEN 'misc_ships/index' || p_partkey || '.htm' WHEN 4 THEN 'links/uss_' || p_partkey || '.html' ELSE 'pages/' || p_partkey || '.jpg' END"


@_query(
    f"""WITH u AS (SELECT p_partkey, {_SHIP_U} AS url FROM part), l AS (SELECT p_partkey, lower(url) AS l FROM u)
SELECT p_partkey, regexp_matches(l, '\\.html?$') AND NOT (regexp_matches(l, 'overview|index|main_page|contact|links|recent_updates') AND NOT contains(l, '/misc_ships/')) AND regexp_matches(l, '/pages/|uss_|_page_|/misc_ships/') AS ship,
  contains(l, 'archives') AND regexp_matches(l, '/(05|04|02|08|10|09|12)/') AS section, regexp_matches(l, 'index|main_page|_main\\.htm|class_overview') AS index_page FROM l"""
)
def directory_pages(spark, sf):
    """Ship, section and index page rules on made-up directory URLs."""
    k = F.col("p_partkey").cast("string")
    ways = [("pages/uss_", ".htm"), ("archives/05/0", ".html"), ("main_page_", ".htm"), ("misc_ships/index", ".htm"), ("links/uss_", ".html"), ("pages/", ".jpg")]
    tail = F.lit(None).cast("string")
    for i, (a, b) in enumerate(ways):
        tail = F.when(F.col("p_partkey") % 6 == i, F.concat(F.lit(a), k, F.lit(b))).otherwise(tail)
    u = F.concat(F.lit("http://ships.example.org/"), tail)
    return _t(spark, sf, "part").select("p_partkey", urls.is_ship_page(u).alias("ship"), urls.is_section_page(u).alias("section"), urls.is_index_page(u).alias("index_page"))


# -- text ---------------------------------------------------------------------

_HULL = "CASE c_custkey % 5 WHEN 0 THEN 'USS Example DDG-' || c_custkey WHEN 1 THEN 'the ' || c_custkey % 1000 || ' class frigate' WHEN 2 THEN 'cvn ' || c_custkey % 100 WHEN 3 THEN 'xdd' || c_custkey ELSE 'DD-123456 cruiser' END"


@_query(
    rf"""SELECT c_custkey, regexp_matches(t, '(?i)\b(?:{"|".join(text.HULL_PREFIXES)})[-\s]?\d{{1,4}}\b') AS strict, regexp_matches(t, '(?i)\b\d{{2,4}}\b.*(?:{"|".join(text.VESSEL_WORDS)})') AS loose,
  regexp_matches(t, '(?i)\b(?:{"|".join(text.HULL_PREFIXES)})[-\s]?\d{{1,4}}\b') OR regexp_matches(t, '(?i)\b\d{{2,4}}\b.*(?:{"|".join(text.VESSEL_WORDS)})') AS title
FROM (SELECT c_custkey, {_HULL} AS t FROM customer)"""
)
def hull_flags(spark, sf):
    """Both hull patterns on made-up titles."""
    k = F.col("c_custkey")
    title = (
        F.when(k % 5 == 0, F.concat(F.lit("USS Example DDG-"), k.cast("string")))
        .when(k % 5 == 1, F.concat(F.lit("the "), (k % 1000).cast("string"), F.lit(" class frigate")))
        .when(k % 5 == 2, F.concat(F.lit("cvn "), (k % 100).cast("string")))
        .when(k % 5 == 3, F.concat(F.lit("xdd"), k.cast("string")))
        .otherwise("DD-123456 cruiser")
    )
    return _t(spark, sf, "customer").select("c_custkey", text.has_strict_hull(title).alias("strict"), text.has_loose_hull(title).alias("loose"), text.title_has_hull(title).alias("title"))


@_query(
    r"""WITH k AS (SELECT doc_id, array_to_string(list_filter(string_split_regex(text, '\s+'), lambda t: t <> '' AND NOT regexp_matches(t, '(?i)(?:"""
    + "|".join(text.WATERMARKS)
    + r""")') AND NOT regexp_matches(t, '^\d{7,}$')), ' ') AS cleaned FROM documents)
SELECT doc_id, md5(cleaned) AS cleaned_md5, length(regexp_replace(cleaned, '[^\p{Nd}]', '', 'g')) AS n_digits, length(regexp_replace(cleaned, '[^\p{L}\p{N}]', '', 'g')) AS n_alnum FROM k"""
)
def token_strip(spark, sf):
    """Texts without watermark tokens, with their digits and alphanumerics."""
    c = text.strip_watermarks(F.col("text"))
    rows = _t(spark, sf, "documents").select("doc_id", c.alias("c"))
    return rows.select("doc_id", F.md5(F.col("c").cast("binary")).alias("cleaned_md5"), text.digits(F.col("c")).cast("long").alias("n_digits"), text.letters_and_digits(F.col("c")).cast("long").alias("n_alnum"))


@_query(
    r"""WITH t AS (SELECT l_orderkey, list(l_shipmode ORDER BY l_linenumber, l_shipmode, l_discount) AS w, max(l_discount) AS conf FROM (SELECT l_orderkey, l_linenumber, l_discount, l_returnflag || l_linenumber AS l_shipmode FROM lineitem) GROUP BY 1)
SELECT l_orderkey, array_to_string(w, ' ') AS ocr_text, conf AS ocr_conf, length(regexp_replace(array_to_string(w, ' '), '[^0-9]', '', 'g')) >= 1 AND length(regexp_replace(array_to_string(w, ' '), '[^0-9A-Za-z]', '', 'g')) <= 8 AS ok FROM t"""
)
def ocr_fold(spark, sf):
    """Token lists folded to a text and a confidence, and judged."""
    rows = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", F.concat("l_returnflag", "l_linenumber").alias("text"), F.col("l_discount").alias("conf")))).alias("tokens")
    )
    body, conf = text.fold_tokens(F.col("tokens"))
    return rows.select("l_orderkey", body.alias("ocr_text"), conf.alias("ocr_conf")).withColumn("ok", text.ocr_accepts(F.col("ocr_text"), 1, 8))


_STATUS = "CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'ConnectTimeout' WHEN 2 THEN 'ReadTimeout' WHEN 3 THEN 'ConnectionError' WHEN 4 THEN 'ConnectionError' ELSE 'SSLError' END"


def _probes(spark, sf):
    k = F.col("event_id") % 6
    kind = F.when(k == 0, "").when(k == 1, "ConnectTimeout").when(k == 2, "ReadTimeout").when(k.isin(3, 4), "ConnectionError").otherwise("SSLError")
    message = F.when(k == 3, "Connection refused by host").otherwise("something else")
    return _t(spark, sf, "events").select("event_id", "event_type", "value", text.error_status(kind, message).alias("status"))


@_query(
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'OK' WHEN 1 THEN 'CONNECT_TIMEOUT' WHEN 2 THEN 'READ_TIMEOUT' WHEN 3 THEN 'CONN_RESET' WHEN 4 THEN 'CONN_ERROR' ELSE 'ERROR' END AS status,
CASE WHEN event_id % 7 > 0 THEN CAST(round(event_id * 3.0 / (event_id % 7)) AS DOUBLE) ELSE 0.0 END AS kbps FROM events"""
)
def probe_status(spark, sf):
    """Status and speed of made-up probes."""
    e = (F.col("event_id") % 7).cast("double")
    return _probes(spark, sf).select("event_id", "status", text.speed_kbps(F.col("event_id") * F.lit(3.0), e).alias("kbps"))


@_query(
    """SELECT event_type, count(*) FILTER (WHERE event_id % 6 = 0) AS n_ok, count(*) FILTER (WHERE event_id % 6 <> 0) AS n_failed, min(value) FILTER (WHERE event_id % 6 = 0) AS min_elapsed,
max(value) FILTER (WHERE event_id % 6 = 0) AS max_elapsed, round(avg(value) FILTER (WHERE event_id % 6 = 0), 4) AS avg_elapsed FROM events GROUP BY 1"""
)
def probe_summary(spark, sf):
    """Good and bad probes and their times by type."""
    return report.probe_summary(_probes(spark, sf).withColumn("elapsed", F.col("value")), "event_type")


@_query("""SELECT CASE WHEN a >= 1 AND b >= 1 THEN 'direct' WHEN c >= 1 THEN 'proxy' ELSE 'check_network' END AS advice, a AS n_a, b AS n_b, c AS n_c FROM (SELECT count(*) FILTER (WHERE event_type = 'click' AND event_id % 6 = 0) AS a, count(*) FILTER (WHERE event_type = 'none' AND event_id % 6 = 0) AS b, count(*) FILTER (WHERE event_id % 6 = 0) AS c FROM events)""")
def probe_advice(spark, sf):
    """What the numbers of good probes advise."""
    ok = F.col("status") == "OK"
    sums = _probes(spark, sf).agg(F.count_if(ok & (F.col("event_type") == "click")).alias("n_a"), F.count_if(ok & (F.col("event_type") == "none")).alias("n_b"), F.count_if(ok).alias("n_c"))
    return sums.select(report.advice(F.col("n_a"), F.col("n_b"), F.col("n_c")).alias("advice"), "n_a", "n_b", "n_c")


@_query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL AND CAST(json_extract_string(props, '$.k') AS INT) > 0")
def props_extract(spark, sf):
    """A key of JSON strings; rows without it or with 0 are left out."""
    return _t(spark, sf, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k")).filter("k > 0")


@_query(
    """SELECT p_partkey, CASE WHEN w = '' OR h = '' THEN true WHEN try_cast(replace(w, 'px', '') AS INT) IS NULL THEN true WHEN try_cast(replace(w, 'px', '') AS INT) < 250 THEN false
WHEN try_cast(replace(h, 'px', '') AS INT) IS NULL THEN true ELSE try_cast(replace(h, 'px', '') AS INT) >= 150 END AS ok
FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN p_size * 20 || 'px' WHEN 2 THEN 'auto' ELSE p_size * 30 || '' END AS w, CASE p_partkey % 3 WHEN 0 THEN 'x' WHEN 1 THEN p_size * 7 || '' ELSE p_size * 9 || 'px' END AS h FROM part)"""
)
def declared_sizes(spark, sf):
    """The declared-size rule on made-up attributes."""
    k, s = F.col("p_partkey"), F.col("p_size")
    w = F.when(k % 4 == 0, "").when(k % 4 == 1, F.concat((s * 20).cast("string"), F.lit("px"))).when(k % 4 == 2, "auto").otherwise((s * 30).cast("string"))
    h = F.when(k % 3 == 0, "x").when(k % 3 == 1, (s * 7).cast("string")).otherwise(F.concat((s * 9).cast("string"), F.lit("px")))
    return _t(spark, sf, "part").select("p_partkey", text.declared_size_ok(w, h).alias("ok"))


# -- pictures by like columns ---------------------------------------------------

_GEO = "least(1024.0::DOUBLE / (p_size * 37 + 11), 768.0::DOUBLE / (p_partkey % 900 + 5))"


@_query(
    f"""SELECT p_partkey, CAST(floor((p_size * 37 + 11) * s) AS INT) AS new_w, CAST(floor((p_partkey % 900 + 5) * s) AS INT) AS new_h,
CAST(floor((1024 - floor((p_size * 37 + 11) * s)) / 2) AS INT) AS dx, CAST(floor((768 - floor((p_partkey % 900 + 5) * s)) / 2) AS INT) AS dy FROM (SELECT *, {_GEO} AS s FROM part)"""
)
def letterbox_geometry(spark, sf):
    """Scaled size and offsets of made-up picture sizes."""
    box = images.letterbox(F.col("p_size") * 37 + 11, F.col("p_partkey") % 900 + 5)
    return _t(spark, sf, "part").select("p_partkey", box.alias("b")).select("p_partkey", "b.*")


@_query("SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'jpeg' WHEN 1 THEN 'png' WHEN 2 THEN 'webp' WHEN 3 THEN 'bmp' END AS format, n_nationkey % 5 < 4 AS allowed FROM nation")
def format_sniff(spark, sf):
    """Formats by first bytes."""
    k = F.col("n_nationkey") % 5
    start = F.when(k == 0, "FFD8FFE000104A46").when(k == 1, "89504E470D0A1A0A0000").when(k == 2, "524946460000000057454250").when(k == 3, "424D000000000000").otherwise("00000000")
    content = F.concat(F.unhex(start), F.col("n_name").cast("binary"))
    return _t(spark, sf, "nation").select("n_nationkey", images.sniff(content).alias("format"), images.is_allowed_format(images.sniff(content)).alias("allowed"))


_BITS = "array_to_string(list_transform(range(1, 64), lambda i: CASE WHEN embedding[i] < embedding[i + 1] THEN '1' ELSE '0' END), '') || '0'"


def _bits(spark, sf):
    e = F.col("embedding")
    bits = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.when(F.get(e, i) < F.get(e, i + 1), "1").otherwise("0")), "")
    return _t(spark, sf, "embeddings").select("vec_id", bits.alias("bits"))


@_query(f"SELECT vec_id, substring(md5({_BITS}), 1, 16) AS dhash FROM embeddings")
def gradient_hashes(spark, sf):
    """Gradient bits of vectors, hashed."""
    return _bits(spark, sf).select("vec_id", images.hash_of_bits(F.col("bits")).alias("dhash"))


@_query(
    f"""WITH b AS (SELECT vec_id, {_BITS} AS s, list_reduce(list_transform(string_split({_BITS}, ''), lambda c: CAST(c AS HUGEINT)), lambda a, c: a * 2 + c) AS v FROM embeddings),
l AS (SELECT min(vec_id) AS id, v FROM b GROUP BY v),
r AS (SELECT min(vec_id) AS id, v FROM (SELECT vec_id, xor(v, CAST(CASE vec_id % 3 WHEN 0 THEN 63 WHEN 1 THEN 7 ELSE 30 END AS HUGEINT) << CAST(vec_id % 50 AS INT)) AS v FROM b) GROUP BY v)
SELECT l.id AS l_id, r.id AS r_id, CAST(bit_count(xor(l.v, r.v)) AS INT) AS distance FROM l, r WHERE bit_count(xor(l.v, r.v)) <= 4"""
)
def near_dup_hamming(spark, sf):
    """Pairs of a vector and one with some bits turned whose 64 bits differ in four at most."""
    rows = _bits(spark, sf).select("vec_id", images.bits_to_long(F.col("bits")).alias("bits"))
    k = F.col("vec_id")
    mask = F.when(k % 3 == 0, 63).when(k % 3 == 1, 7).otherwise(30).cast("long")
    turned = rows.withColumn("bits", F.col("bits").bitwiseXOR(F.call_function("shiftleft", mask, (k % 50).cast("int"))))
    return dedup.near_pairs(rows, turned, "vec_id", "vec_id")


# -- duplicates, history --------------------------------------------------------


@_query("SELECT doc_id, sha1(text) AS sha1 FROM documents")
def content_sha1(spark, sf):
    """SHA-1 of every text."""
    return _t(spark, sf, "documents").select("doc_id", images.file_sha1(F.col("text").cast("binary")).alias("sha1"))


@_query("SELECT doc_id, sha1 FROM (SELECT doc_id, sha1(text) AS sha1, row_number() OVER (PARTITION BY sha1(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def doc_exact_dedup(spark, sf):
    """The first document of every text."""
    return dedup.first_seen(content_sha1(spark, sf), ["sha1"], ["doc_id"])


def _like_candidates(spark, sf):
    rows = _t(spark, sf, "pages")
    return rows.select("page_id", F.col("url").alias("image_url"), urls.host(F.col("url")).alias("page_url"), F.sha1(F.col("html").cast("binary")).alias("sha1"))


@_query(
    f"""WITH c AS (SELECT page_id, url, {_STRIP.format("url")} AS canonical, {_HOST.format("url")} AS host FROM pages), h AS (SELECT * FROM c WHERE page_id % 7 = 0)
SELECT page_id FROM c WHERE page_id % 7 <> 0 AND url NOT IN (SELECT url FROM h) AND canonical NOT IN (SELECT canonical FROM h) AND host NOT IN (SELECT host FROM h)"""
)
def history_anti_join(spark, sf):
    """Pages that history has neither by URL, canonical URL nor host."""
    rows = _like_candidates(spark, sf)
    known = rows.filter("page_id % 7 = 0").withColumn("canonical_url", urls.canonical(F.col("image_url")))
    return dedup.against_history(rows.filter("page_id % 7 <> 0"), known).select("page_id")


@_query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def not_yet_labelled(spark, sf):
    """Documents without a label."""
    docs = _t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("k"), "doc_id")
    return dedup.against_keys(docs, "k", _t(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("k")), "k").select("doc_id")


@_query("SELECT doc_id FROM documents WHERE sha1(text) NOT IN (SELECT sha1(text) FROM documents WHERE source = 'src1') AND source <> 'src1'")
def content_anti_join(spark, sf):
    """Documents whose text one source does not have."""
    rows = _t(spark, sf, "documents").select("doc_id", "source", F.sha1(F.col("text").cast("binary")).alias("sha1"))
    return dedup.against_keys(rows.filter("source <> 'src1'"), "sha1", rows.filter("source = 'src1'"), "sha1").select("doc_id")


@_query("SELECT p_partkey || '.jpg' AS file_name FROM part WHERE p_partkey NOT IN (SELECT l_suppkey FROM lineitem)")
def orphan_files(spark, sf):
    """File names that no accepted row has."""
    name = lambda c: F.concat(F.col(c).cast("string"), F.lit(".jpg")).alias("file_name")
    return dedup.orphans(_t(spark, sf, "part").select(name("p_partkey")), _t(spark, sf, "lineitem").select(name("l_suppkey")))


@_query("WITH l AS (SELECT p_name AS title, arg_max(p_brand, p_partkey) AS image_url FROM part GROUP BY 1) SELECT p.p_partkey, l.image_url FROM part p JOIN l ON l.title = p.p_name")
def title_lookup(spark, sf):
    """Titles with what the lookup has for them, the last of several."""
    part = _t(spark, sf, "part")
    found = part.select(F.col("p_name").alias("title"), F.col("p_brand").alias("image_url"), F.col("p_partkey").alias("ord"))
    return extract.lookup(part.select("p_partkey", F.col("p_name").alias("title")), found).select("p_partkey", "image_url")


@_query("SELECT n_name AS k FROM nation UNION SELECT r_name FROM region UNION SELECT c_mktsegment FROM customer")
def history_union(spark, sf):
    """The set union of keys of three tables."""
    one = _t(spark, sf, "nation").select(F.col("n_name").alias("k"))
    return one.union(_t(spark, sf, "region").select("r_name")).union(_t(spark, sf, "customer").select("c_mktsegment")).distinct()


@_query("SELECT source, count(*) AS n FROM (SELECT 'customer' AS source, c_custkey AS k FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier) GROUP BY 1")
def source_union(spark, sf):
    """The bag union of two sources, counted."""
    a = _t(spark, sf, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("k"))
    return a.unionByName(_t(spark, sf, "supplier").select(F.lit("supplier").alias("source"), F.col("s_suppkey").alias("k"))).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


# -- cascade, caps, batches -------------------------------------------------------

_CASCADE = """SELECT d.doc_id, CASE WHEN n_chars < 200 THEN 'too_small_file' WHEN lang NOT IN ('en', 'de') THEN 'invalid_format' WHEN f.first < d.doc_id THEN 'duplicate_sha1'
  WHEN n_chars % 10 = 0 THEN 'download_failed_' || d.source WHEN l.quality = 0 THEN 'blurry' ELSE 'accepted' END AS disposition
FROM documents d JOIN (SELECT sha1(text) AS s, min(doc_id) AS first FROM documents GROUP BY 1) f ON f.s = sha1(d.text) LEFT JOIN labels l ON l.doc_id = d.doc_id"""


def _judged(spark, sf):
    docs = _t(spark, sf, "documents").withColumn("s", F.sha1(F.col("text").cast("binary")))
    first = docs.groupBy(F.col("s").alias("_s")).agg(F.min("doc_id").alias("first"))
    labels = _t(spark, sf, "labels").select(F.col("doc_id").alias("_id"), "quality")
    rows = docs.select("doc_id", "n_chars", "lang", "source", "s").join(first, F.col("s") == F.col("_s")).join(labels, F.col("doc_id") == F.col("_id"), "left")
    rules = [
        ("too_small_file", F.col("n_chars") < 200),
        ("invalid_format", ~F.col("lang").isin("en", "de")),
        ("duplicate_sha1", F.col("first") < F.col("doc_id")),
        (F.concat(F.lit("download_failed_"), F.col("source")), F.col("n_chars") % 10 == 0),
        ("blurry", F.col("quality") == 0),
    ]
    return rows.select("doc_id", "source", cascade.disposition(rules).alias("disposition"))


@_query(_CASCADE)
def disposition_cascade(spark, sf):
    """One disposition for every document: the first rule it breaks."""
    return _judged(spark, sf).select("doc_id", "disposition")


@_query(f"SELECT disposition AS reason, count(*) AS n FROM ({_CASCADE}) GROUP BY 1")
def reason_counts(spark, sf):
    """Documents by disposition."""
    return cascade.reason_counts(_judged(spark, sf))


@_query(
    f"""WITH c AS ({_CASCADE}), x AS (SELECT CASE WHEN starts_with(disposition, 'download_failed_') THEN 'download_failed' ELSE disposition END AS reason,
CASE WHEN starts_with(disposition, 'download_failed_') THEN substring(disposition, 17) ELSE '' END AS error_type FROM c)
SELECT reason, CAST(NULL AS VARCHAR) AS error_type, count(*) AS n FROM x GROUP BY reason UNION ALL SELECT reason, error_type, count(*) FROM x WHERE error_type <> '' GROUP BY 1, 2"""
)
def reason_rollup(spark, sf):
    """Reasons with their totals, failed downloads also by type."""
    return cascade.failure_rollup(_judged(spark, sf))


@_query(f"SELECT disposition AS reason, count(*) AS n FROM ({_CASCADE}) WHERE disposition <> 'accepted' GROUP BY 1 ORDER BY n DESC, reason LIMIT 5")
def top_reasons(spark, sf):
    """The five commonest reasons."""
    return report.top(cascade.reason_counts(_judged(spark, sf)).filter("reason <> 'accepted'"), 5)


@_query(
    f"""WITH c AS ({_CASCADE}) SELECT count(*) AS total_candidates, count(*) FILTER (WHERE disposition = 'accepted') AS accepted, 5000 - count(*) FILTER (WHERE disposition = 'accepted') AS remaining_to_target,
round(count(*) FILTER (WHERE disposition = 'accepted') / 2.0, 1) AS accepted_per_hour, round(count(*) FILTER (WHERE disposition = 'accepted' AND doc_id % 3 = 0) * 100.0 / count(*) FILTER (WHERE disposition = 'accepted'), 1) AS metadata_pct FROM c"""
)
def run_report(spark, sf):
    """Counters and rates of the judged documents."""
    rows = _judged(spark, sf).withColumn("ocr_ok", F.lit(True)).withColumn("fast_path", F.col("doc_id") % 3 == 0)
    return report.report(rows, 5000, 7200.0).select("total_candidates", "accepted", "remaining_to_target", "accepted_per_hour", "metadata_pct")


@_query("SELECT doc_id, doc_id % 10 = min(doc_id % 10) OVER (PARTITION BY sha1(text)) AS accepted FROM documents")
def batch_snapshot_sha1(spark, sf):
    """Content hashes under the batch rule: all copies of the first batch pass."""
    rows = _t(spark, sf, "documents").select("doc_id", (F.col("doc_id") % 10).alias("batch"), F.sha1(F.col("text").cast("binary")).alias("sha1"))
    return select.snapshot_keys(rows, "sha1", "batch", F.lit(True)).select("doc_id", "accepted")


@_query("SELECT doc_id, coalesce(sum(1) OVER (PARTITION BY source ORDER BY doc_id // 100 RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 3 AS accepted FROM documents")
def batch_page_cap(spark, sf):
    """The page cap under the batch rule."""
    rows = _t(spark, sf, "documents").select("doc_id", "source", F.floor(F.col("doc_id") / 100).alias("batch"))
    return select.snapshot_cap(rows, "source", "batch", F.lit(True), 3).select("doc_id", "accepted")


@_query("SELECT source, count(*) AS n FROM (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 40 GROUP BY 1")
def source_limits(spark, sf):
    """At most forty documents of each source, counted."""
    rows = _t(spark, sf, "documents").select("source", "doc_id")
    return select.cap(rows, ["source"], [F.col("doc_id")], 40).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


_RANK = "CASE source WHEN 'src1' THEN 0 WHEN 'src2' THEN 1 ELSE 9 END"


@_query(f"SELECT doc_id, row_number() OVER (ORDER BY n_chars % 2, {_RANK}, doc_id) AS place FROM documents")
def priority_order(spark, sf):
    """Every document's place by flag, source rank and id."""
    rank = F.when(F.col("source") == "src1", 0).when(F.col("source") == "src2", 1).otherwise(9)
    rows = _t(spark, sf, "documents").select("doc_id", (F.col("n_chars") % 2 * 10 + rank).alias("p"))
    lead = F.col("p") * F.lit(float(1 << 40)) + F.col("doc_id")
    return select.numbered(rows, [F.col("p"), F.col("doc_id")], lead, "place").select("doc_id", F.col("place").cast("long").alias("place"))


@_query("SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 100 + 1 AS batch FROM events")
def micro_batches(spark, sf):
    """Batch numbers by position."""
    rows = select.numbered(_t(spark, sf, "events").select("event_id"), [F.col("event_id")], F.col("event_id"))
    return rows.select("event_id", select.batch_number(F.col("position"), 100).alias("batch"))


@_query("SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 30")
def seeded_sample(spark, sf):
    """Thirty documents by a seeded order."""
    return select.sample(_t(spark, sf, "documents").select("doc_id"), F.col("doc_id"), 30)


@_query("SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= greatest(1, CAST(floor((SELECT count(*) FROM documents) * 0.85) AS BIGINT)) THEN 'train' ELSE 'test' END AS split FROM documents")
def split_85_15(spark, sf):
    """An exact seeded split."""
    return select.split(_t(spark, sf, "documents").select("doc_id"), F.col("doc_id"))


@_query("SELECT doc_id, n_chars >= 500 AND coalesce(r, 0) <= 250 AS taken FROM (SELECT doc_id, n_chars, CASE WHEN n_chars >= 500 THEN row_number() OVER (PARTITION BY n_chars >= 500 ORDER BY doc_id) END AS r FROM documents)")
def quota_accept(spark, sf):
    """The first 250 documents that pass, the rest dropped."""
    rows = _t(spark, sf, "documents").select("doc_id", "n_chars")
    return select.quota(rows, F.col("n_chars") >= 500, [F.col("doc_id")], F.col("doc_id"), 250).select("doc_id", "taken")


@_query("WITH n AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS p FROM conversations) SELECT conv_id, turn FROM n WHERE p > 200 ORDER BY md5('42:' || p), p LIMIT 30")
def review_slice(spark, sf):
    """A seeded sample of what came after the last review."""
    lead = F.col("conv_id") * F.lit(float(1 << 20)) + F.col("turn")
    rows = select.numbered(_t(spark, sf, "conversations").select("conv_id", "turn"), [F.col("conv_id"), F.col("turn")], lead, "p")
    return select.since_review(rows, F.col("p"), 200, key=F.col("p").cast("long")).select("conv_id", "turn")


@_query("SELECT list_aggregate(list_sort(list(DISTINCT source)), 'string_agg', ',') AS sources, count(*) AS n FROM documents")
def sorted_keys(spark, sf):
    """The sorted set of keys, as the state export lists it."""
    return _t(spark, sf, "documents").agg(F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"), F.count(F.lit(1)).alias("n"))


# -- snapshots over time -----------------------------------------------------------

_DAILY = "d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE event_type = 'click') AS clicks FROM events GROUP BY 1, 2), c AS (SELECT user_id, day, sum(n) OVER (PARTITION BY user_id ORDER BY day) AS total, n FROM d)"


def _daily(spark, sf):
    rows = _t(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("user_id").orderBy("day"))
    return rows.select("user_id", F.col("day").cast("timestamp").alias("ts"), "day", total.alias("total"), "n")


@_query(f"WITH {_DAILY} SELECT user_id, strftime(day, '%Y-%m-%d') AS day, CAST(total - lag(total) OVER w AS BIGINT) AS new_count, CAST(date_diff('second', lag(day) OVER w, day) AS DOUBLE) AS elapsed FROM c WINDOW w AS (PARTITION BY user_id ORDER BY day)")
def monitor_delta(spark, sf):
    """The change of each user's running count, and the time it took."""
    rows = monitor.deltas(_daily(spark, sf), "user_id", "ts", "total")
    return rows.select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "new_count", "elapsed")


@_query(
    f"""WITH RECURSIVE {_DAILY}, g AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY day) AS i, n - 1 AS gain FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS k FROM c) WHERE k > 1),
r AS (SELECT user_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS streak, CAST(0 AS BIGINT) AS alerts FROM (SELECT DISTINCT user_id FROM g)
UNION ALL SELECT r.user_id, g.i, CASE WHEN g.gain > 0 AND g.gain < 5 THEN CASE WHEN r.streak + 1 >= 2 THEN 0 ELSE r.streak + 1 END ELSE greatest(0, r.streak - 1) END, r.alerts + CASE WHEN g.gain > 0 AND g.gain < 5 AND r.streak + 1 >= 2 THEN 1 ELSE 0 END
FROM r JOIN g ON g.user_id = r.user_id AND g.i = r.i + 1)
SELECT user_id, arg_max(alerts, i) AS alerts, arg_max(streak, i) AS streak FROM r GROUP BY 1"""
)
def monitor_streak(spark, sf):
    """Low-yield alerts of each user's daily gains."""
    rows = monitor.deltas(_daily(spark, sf), "user_id", "ts", "total").withColumn("gain", F.col("new_count") - 1)
    return monitor.low_yield_alerts(rows, "user_id", "ts", "gain")


@_query(
    f"""WITH {_DAILY}, x AS (SELECT user_id, day, CASE WHEN row_number() OVER w = 1 OR n >= 4 THEN day END AS moved FROM c WINDOW w AS (PARTITION BY user_id ORDER BY day)),
y AS (SELECT user_id, day, date_diff('second', max(moved) OVER (PARTITION BY user_id ORDER BY day), day) AS idle FROM x)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, CAST(idle AS DOUBLE) AS idle, idle > 100000 AND NOT coalesce(lag(idle > 100000) OVER (PARTITION BY user_id ORDER BY day), false) AS stall FROM y"""
)
def monitor_stall(spark, sf):
    """Idle time of each user, and where a stall is told."""
    rows = monitor.deltas(_daily(spark, sf), "user_id", "ts", "total").withColumn("gain", F.when(F.col("new_count").isNotNull(), F.when(F.col("new_count") >= 4, 1).otherwise(0)))
    return monitor.stalls(rows, "user_id", "ts", "gain", 100000.0).select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "idle", "stall")


@_query("WITH b AS (SELECT event_id // 1000 AS batch, event_type, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT batch, event_type, n, sum(n) OVER (PARTITION BY event_type ORDER BY batch) AS total FROM b) SELECT batch, event_type, CAST(total - coalesce(lag(total) OVER (PARTITION BY event_type ORDER BY batch), 0) AS BIGINT) AS delta FROM r")
def batch_deltas(spark, sf):
    """What each batch added to running counters."""
    rows = _t(spark, sf, "events").groupBy(F.floor(F.col("event_id") / 1000).alias("batch"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("event_type").orderBy("batch")
    running = rows.withColumn("total", F.sum("n").over(w))
    return running.select("batch", "event_type", (F.col("total") - F.coalesce(F.lag("total").over(w), F.lit(0))).alias("delta")).filter("delta > 0")


@_query("SELECT event_type, CASE WHEN dl > 2 * o THEN 'downloads' ELSE 'candidates' END AS cause, dl AS download_failed, o AS other FROM (SELECT event_type, count(*) FILTER (WHERE event_id % 6 = 1) AS dl, count(*) FILTER (WHERE event_id % 6 IN (4, 5)) AS o FROM events GROUP BY 1)")
def rejection_diagnosis(spark, sf):
    """Failed downloads against all other rejections."""
    k = F.col("event_id") % 6
    name = F.when(k == 1, "download_failed").when(k == 2, "download_failed_Timeout").when(k == 4, "blurry").when(k == 5, "too_small_dims")
    rows = _t(spark, sf, "events").select("event_type", name.alias("r")).groupBy("event_type", "r").agg(F.count(F.lit(1)).alias("n")).filter("r IS NOT NULL")
    maps = rows.groupBy("event_type").agg(F.map_from_entries(F.collect_list(F.struct("r", "n"))).alias("m"))
    return maps.select("event_type", monitor.diagnosis(F.col("m")).alias("d")).select("event_type", "d.cause", "d.download_failed", "d.other")


# -- graph ---------------------------------------------------------------------------

_EDGES = "e AS (SELECT DISTINCT l_partkey AS s, l_suppkey + 1000000 AS d FROM lineitem UNION SELECT DISTINCT l_suppkey + 1000000, l_partkey FROM lineitem)"


def _both_ways(spark, sf):
    """Edges between parts and their suppliers."""
    items = _t(spark, sf, "lineitem").select(F.col("l_partkey").alias("src"), (F.col("l_suppkey") + 1000000).alias("dst")).distinct()
    return items.union(items.select("dst", "src"))


@_query(f"WITH RECURSIVE {_EDGES}, r AS (SELECT CAST(1 AS BIGINT) AS node UNION SELECT e.d FROM r JOIN e ON e.s = r.node) SELECT node FROM r")
def bfs_reach(spark, sf):
    """All parts and suppliers that part 1 is linked with, over any number of steps."""
    return graph.reach(_both_ways(spark, sf), spark.range(1, 2).select(F.col("id").alias("node"))).select("node")


@_query(f"WITH {_EDGES} SELECT DISTINCT d AS node FROM e WHERE s IN (SELECT p_partkey FROM part)")
def one_hop(spark, sf):
    """Direct neighbours of all parts."""
    return graph.one_hop(_both_ways(spark, sf), _t(spark, sf, "part").select("p_partkey"))
