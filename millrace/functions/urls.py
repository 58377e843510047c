"""URL functions: Column to Column, built-ins only.

A null URL gives null, an empty one the empty string, unless a docstring says
otherwise.  Regular expressions replace ``parse_url``, which refuses URLs with
spaces or letters beyond ASCII.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks of thumbnails, in the order they are looked for.
THUMBNAIL_MARKS = ("_tn.", "-tn.", "_small.", "-small.", "_thumb.", "-thumb.", "_thumbnail.", "-thumbnail.")

# Stock and social domains whose pictures are refused.
BLOCKED_DOMAINS = (
    "alamy.com", "alamy.", "shutterstock.com", "shutterstock.",
    "gettyimages.com", "getty.", "123rf.com", "123rf.",
    "dreamstime.com", "dreamstime.", "depositphotos.com",
    "istockphoto.com", "istock.", "bigstockphoto.com",
    "adobestock.com", "canstockphoto.com",
    "pinterest.com", "pinimg.com",
    "facebook.com", "fbcdn.net",
    "instagram.com", "cdninstagram.com",
    "twitter.com", "twimg.com",
    "tiktok.com", "youtube.com", "ytimg.com",
    "freepik.com", "vectorstock.com", "vecteezy.com",
)

# Words in picture URLs that mean no photograph.
BAD_KEYWORDS = (
    "logo", "icon", "banner", "button", "flag", "avatar",
    "thumbnail", "thumb", "preview", "placeholder",
    "watermark", "wm.", "-wm-", "_wm_",
    "game", "model", "toy", "hobby", "3d", "render", "painting", "decal",
    "sprite", "stamp", "badge", "sticker",
    "map", "chart", "diagram", "illustration",
)

# The two directory sites' lists.
DIRECTORY_EXTENSIONS = {"navsource": (".jpg", ".jpeg", ".png", ".webp", ".gif"), "maritimequest": (".jpg", ".jpeg", ".png", ".webp")}
LAYOUT_WORDS = {
    "navsource": ("banner", "navigate", "flag", "logo", "button", "icon", "line", "divider"),
    "maritimequest": ("banner", "navigate", "flag", "logo", "button", "icon"),
}
BLOCKED_PATHS = {
    "navsource": ("/contact", "/links", "/faq", "/about", "/updates", "/whatsnew", "/search", "/help", "/privacy"),
    "maritimequest": (
        "/misc_pages/", "/monuments", "/memorial", "/site_info_pages/",
        "/alphabetical_listing/", "/daily_event", "/library", "/in_the_news",
        "/links", "/photo_gallery", "/miscellaneous",
    ),
}
SECTIONS = ("/05/", "/04/", "/02/", "/08/", "/10/", "/09/", "/12/")
SHIP_PAGE_MARKS = ("/pages/", "uss_", "_page_", "/misc_ships/")
SHIP_PAGE_EXCLUSIONS = ("overview", "index", "main_page", "contact", "links", "recent_updates")
SHIP_PAGE_EXEMPTION = "/misc_ships/"
INDEX_PAGE_MARKS = (
    "index", "main_page", "_main.htm", "hull_index",
    "hull_number_index", "alpha_index", "ship_index",
    "dd_index_alpha_pages", "class_overview",
)

_HEAD = r"(?s)^((?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?)(.*)$"


def _any(text: Column, parts: tuple[str, ...]) -> Column:
    """Whether any part stands in the text, as written."""
    return reduce(lambda a, b: a | b, [text.contains(p) for p in parts])


def _ends(text: Column, ends: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.endswith(e) for e in ends])


def host(url: Column) -> Column:
    """The authority, lower case, without a leading user part; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def strip_url(url: Column) -> Column:
    """Without parameters of the last path segment, query and fragment; the scheme in lower case."""
    bare = F.regexp_replace(url, r"(?s)[?#].*$", "")
    head = F.regexp_extract(bare, _HEAD, 1)
    path = F.regexp_replace(F.regexp_extract(bare, _HEAD, 2), r"(?s);[^/]*$", "")
    scheme = F.regexp_extract(head, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    return F.concat(F.lower(scheme), F.substring(head, F.length(scheme) + 1, F.length(head)), path)


def canonical(url: Column) -> Column:
    """``strip_url``; where a thumbnail mark is found, the first kind in the table,
    all in lower case with a dot for every such mark."""
    clean = strip_url(url)
    low = F.lower(clean)
    out = None
    for mark in THUMBNAIL_MARKS:
        test, value = low.contains(mark), F.replace(low, F.lit(mark), F.lit("."))
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(clean)


def _without_dots(path: Column) -> Column:
    """An absolute path without "." and ".." segments."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    step = lambda a, x: (
        F.when(x == ".", a).when(x == "..", F.when(F.size(a) > 1, F.slice(a, F.lit(1), F.size(a) - 1)).otherwise(a)).otherwise(F.concat(a, F.array(x)))
    )
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    joined = F.array_join(kept, "/")
    return F.when(last.isin(".", ".."), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve(base: Column, link: Column) -> Column:
    """A link as seen from a page: absolute, scheme-relative, rooted, query, fragment or relative."""
    bare = F.regexp_replace(base, r"(?s)#.*$", "")
    no_query = F.regexp_replace(bare, r"(?s)\?.*$", "")
    origin = F.regexp_extract(no_query, _HEAD, 1)
    path = F.regexp_extract(no_query, _HEAD, 2)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"(?s)[^/]*$", ""))
    tail = F.regexp_extract(link, r"(?s)^[^?#]*(.*)$", 1)
    own = F.regexp_extract(link, r"(?s)^([^?#]*)", 1)
    return (
        F.when(link == "", base)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1), link))
        .when(link.startswith("/"), F.concat(origin, _without_dots(own), tail))
        .when(link.startswith("?"), F.concat(no_query, link))
        .when(link.startswith("#"), F.concat(bare, link))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, own)), tail))
    )


def percent_encode(text: Column) -> Column:
    """Percent-encoding of UTF-8 that keeps letters, digits and ``_.-~/``."""
    out = F.url_encode(text)
    for old, new in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def source_id(url: Column) -> Column:
    """The first 16 hexadecimal digits of the URL's MD5."""
    return F.substring(F.md5(url.cast("binary")), 1, 16)


def is_blocked_domain(url: Column) -> Column:
    return _any(F.lower(url), BLOCKED_DOMAINS)


def is_bad_keyword(url: Column) -> Column:
    """A raw substring test: "map" also hits inside longer words."""
    return _any(F.lower(url), BAD_KEYWORDS)


def has_domain(domain: str, *urls: Column) -> Column:
    """Whether the domain stands in any of the URLs joined together."""
    return F.lower(F.concat(*[F.coalesce(u, F.lit("")) for u in urls])).contains(domain)


def has_picture_extension(url: Column, site: str) -> Column:
    """Tested on the whole URL, query included."""
    return _ends(F.lower(url), DIRECTORY_EXTENSIONS[site])


def is_layout_picture(url: Column, site: str) -> Column:
    return _any(F.lower(url), LAYOUT_WORDS[site])


def is_blocked_path(url: Column, site: str) -> Column:
    return _any(F.lower(url), BLOCKED_PATHS[site])


def is_html_page(url: Column) -> Column:
    return _ends(F.lower(url), (".htm", ".html"))


def is_section_page(url: Column) -> Column:
    """An archive page of one of the numbered sections."""
    low = F.lower(url)
    return low.contains("archives") & _any(low, SECTIONS)


def is_ship_page(url: Column) -> Column:
    low = F.lower(url)
    excluded = _any(low, SHIP_PAGE_EXCLUSIONS) & ~low.contains(SHIP_PAGE_EXEMPTION)
    return is_html_page(url) & ~excluded & _any(low, SHIP_PAGE_MARKS)


def is_index_page(url: Column) -> Column:
    return _any(F.lower(url), INDEX_PAGE_MARKS)
