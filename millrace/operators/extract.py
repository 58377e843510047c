"""One page to many rows: links, images, embedded JSON.

Scripts, styles and comments are taken out before tags are looked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text, urls
from millrace.operators import graph

_QUIET = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
_IMG = r"(?is)(<img\s[^>]*>)"

# Character references that attributes of landed pages hold.
_ENTITIES = (("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&"))


def unescape(value: Column) -> Column:
    """Common character references, "&amp;" last."""
    for old, new in _ENTITIES:
        value = F.replace(value, F.lit(old), F.lit(new))
    return value


def quiet(html: Column) -> Column:
    return F.regexp_replace(html, _QUIET, " ")


def attribute(tag: Column, name: str) -> Column:
    """An attribute of a tag's text, null if it is missing."""
    found = F.regexp_extract_all(tag, F.lit(rf"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"), F.lit(0))
    value = F.regexp_replace(F.regexp_replace(F.get(found, F.lit(0)), r"(?is)^\s\w+\s*=\s*", ""), r"^[\"']|[\"']$", "")
    return unescape(value)


def page_title(html: Column) -> Column:
    """The title's text, white space collapsed; empty if there is none."""
    inner = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title\s*>", 1)
    return unescape(F.trim(F.regexp_replace(F.regexp_replace(inner, "<[^>]*>", " "), r"\s+", " ")))


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """All columns but the page's text, with ``ord``, ``href`` and ``absolute`` of every link that has one."""
    tags = F.regexp_extract_all(quiet(F.col(html)), F.lit(r"(?is)(<a\s[^>]*>)"), F.lit(1))
    rows = pages.select(*(c for c in pages.columns if c != html), F.posexplode(tags).alias("ord", "_tag"))
    rows = rows.withColumn("href", F.trim(attribute(F.col("_tag"), "href"))).filter("href <> ''").drop("_tag")
    return rows.withColumn("absolute", urls.resolve(F.col(url), F.col("href")))


def pictures(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """All columns but the page's text, with ``ord``, ``image_url``, ``width``, ``height`` of every picture."""
    tags = F.regexp_extract_all(quiet(F.col(html)), F.lit(_IMG), F.lit(1))
    rows = pages.select(*(c for c in pages.columns if c != html), page_title(F.col(html)).alias("title"), F.posexplode(tags).alias("ord", "_tag"))
    rows = rows.select("*", F.trim(attribute(F.col("_tag"), "src")).alias("_src"), attribute(F.col("_tag"), "width").alias("width"), attribute(F.col("_tag"), "height").alias("height"))
    return rows.filter("_src <> ''").withColumn("image_url", urls.resolve(F.col(url), F.col("_src"))).drop("_src", "_tag")


def directory_candidates(pages: DataFrame, site: str, url: str = "url", html: str = "html") -> DataFrame:
    """Candidates of a directory site's ship pages: extension, layout, keyword and size rules."""
    image = F.col("image_url")
    good = urls.has_picture_extension(image, site) & ~urls.is_layout_picture(image, site) & ~urls.is_bad_keyword(image) & text.declared_size_ok(F.col("width"), F.col("height"))
    rows = pictures(pages, url, html).filter(good)
    hull = text.title_has_hull(F.col("title")) | text.has_strict_hull(F.col(url))
    return rows.select(F.lit(site).alias("source"), F.col(url).alias("page_url"), "image_url", urls.source_id(image).alias("source_id"), "title", hull.alias("has_hull_in_title"), "ord")


def crawl(pages: DataFrame, roots: DataFrame, site: str, max_found: int = 500) -> DataFrame:
    """Candidates of the ship pages that the roots reach by links over landed pages.

    pages: url, html; roots: url.  Links to other than pages, and to the site's
    blocked paths, are not followed.
    """
    target = F.col("absolute")
    steps = links(pages.select("url", "html")).filter(urls.is_html_page(target) & ~urls.is_blocked_path(target, site))
    seen = graph.reach(steps.select(F.col("url").alias("src"), target.alias("dst")).distinct(), roots.select("url"), max_found=max_found)
    reached = pages.join(seen.select("node"), F.col("url") == F.col("node"), "left_semi").filter(urls.is_ship_page(F.col("url")))
    return directory_candidates(reached, site)


def search_results(pages: DataFrame, html: str = "html") -> DataFrame:
    """Picture, page and title of the JSON objects in a search page's ``m`` attributes.

    Objects that don't parse or have no picture URL are skipped.
    """
    raw = F.regexp_extract_all(F.col(html), F.lit(r"(?:^|\W)m=\"(\{&quot;[^\n]*?\})\""), F.lit(1))
    rows = pages.select(*(c for c in pages.columns if c != html), F.posexplode(raw).alias("ord", "_raw"))
    got = F.from_json(unescape(F.col("_raw")), "murl string, purl string, t string")
    rows = rows.withColumn("_got", got).filter("_got.murl IS NOT NULL AND _got.murl <> ''")
    return rows.select(*(c for c in rows.columns if not c.startswith("_")), F.col("_got.murl").alias("image_url"), text.key(F.col("_got.purl")).alias("page_url"), text.key(F.col("_got.t")).alias("title"))


def search_candidates(results: DataFrame, source: str, domain: str | None = None) -> DataFrame:
    """Search results that are no stock pictures, or that belong to a domain."""
    image, page = F.col("image_url"), F.col("page_url")
    good = (image != "") & (urls.has_domain(domain, page, image) if domain else ~(urls.is_blocked_domain(image) | urls.is_blocked_domain(page) | urls.is_bad_keyword(image)))
    hull = text.title_has_hull(F.col("title")) | text.has_strict_hull(image)
    return results.filter(good).select(F.lit(source).alias("source"), "page_url", "image_url", urls.source_id(image).alias("source_id"), "title", hull.alias("has_hull_in_title"), "ord")


_API = "query struct<search:array<struct<title:string>>,pages:map<string,struct<title:string,imageinfo:array<struct<thumburl:string,url:string,width:int,height:int>>>>>"


def api_titles(responses: DataFrame, body: str = "body") -> DataFrame:
    """Titles of a search API's answers that name files."""
    rows = responses.select(*(c for c in responses.columns if c != body), F.posexplode(F.from_json(F.col(body), _API)["query"]["search"]).alias("ord", "_hit"))
    return rows.withColumn("title", F.col("_hit.title")).drop("_hit").filter(text.is_file_title(F.col("title")))


def api_pictures(responses: DataFrame, body: str = "body", least_width: int = 500, least_height: int = 350) -> DataFrame:
    """title and image_url of the lookup API's answers; the thumbnail's URL if there is one."""
    pages = F.map_values(F.from_json(F.col(body), _API)["query"]["pages"])
    rows = responses.select(F.posexplode(pages).alias("ord", "_page"))
    info = F.get(F.col("_page.imageinfo"), F.lit(0))
    url = F.coalesce(F.nullif(info["thumburl"], F.lit("")), info["url"])
    return rows.select("ord", F.col("_page.title").alias("title"), url.alias("image_url"), info["width"].alias("w"), info["height"].alias("h")).filter(
        (F.col("image_url") != "") & (F.col("w") >= least_width) & (F.col("h") >= least_height)
    )


def lookup(titles: DataFrame, found: DataFrame) -> DataFrame:
    """Titles with the picture that the lookup gave them; of several the last by ``ord``."""
    last = found.groupBy(F.col("title").alias("_title")).agg(F.max_by("image_url", "ord").alias("image_url"))
    return titles.join(last, F.col("title") == F.col("_title")).drop("_title")
