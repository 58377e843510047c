"""Text functions and predicates: Column to Column, built-ins only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Case-insensitive, Unicode classes and case, and "." stops at line feeds only.
_FLAGS = "(?iuUd)"

# Prefixes of hull numbers and words for vessels.
HULL_PREFIXES = "DDG DD FFG FF CG CVN CVA CV LHD LPD LHA LCS SSN SSBN SSG SS PC WHEC WMEC WPB PB".split()
VESSEL_WORDS = "destroyer frigate cruiser carrier submarine amphibious corvette patrol".split()

# What marks a token as a watermark or credit.
WATERMARKS = (
    r"www\.[a-z0-9\-]+\.(com|org|net|gov|mil|co\.[a-z]+)",
    r"[a-z0-9\-]+\.(com|org|net|gov|mil)",
    r"https?://\S+",
    r"©.*",
    r"\(c\).*",
    r"copyright.*",
    r"photo\s*(by|credit|courtesy).*",
    r"credit.*",
    r"source.*",
    r"(maritimequest|navsource|seaforces|usni|dvidshub|flickr|wikimedia)",
    r"(getty|shutterstock|alamy|reuters|ap\s+photo)",
    r"(photographer|photograph|image|picture)\s*(by|credit|courtesy)?",
    r"\d{5,}\.jpg",
    r"u\.s\.\s*naval\s*institute",
    r"usni\s*photo",
)

#: One of these stands, in lower case, in whatever ASCII token the patterns above can match.
_HEADS = (
    ".", "(c)", "http", "copyright", "photo", "credit", "source", "maritimequest", "navsource", "seaforces", "usni", "dvidshub",
    "flickr", "wikimedia", "getty", "shutterstock", "alamy", "reuters", "image", "picture",
)

STRICT_HULL = rf"{_FLAGS}\b(?:{'|'.join(HULL_PREFIXES)})[-\s]?\d{{1,4}}\b"
LOOSE_HULL = rf"{_FLAGS}\b\d{{2,4}}\b.*(?:{'|'.join(VESSEL_WORDS)})"

# Two-letter prefixes and ranks of the sources.
SOURCE_PREFIX = {"bing": "bi", "usni": "un", "maritimequest": "mq", "wikimedia": "wk", "navsource": "ns"}
SOURCE_RANK = {"maritimequest": 0, "bing": 1, "usni": 2, "navsource": 3, "wikimedia": 4}


def key(text: Column) -> Column:
    """A trimmed key; null counts as no key, the empty string."""
    return F.coalesce(F.trim(text), F.lit(""))


def has_strict_hull(text: Column) -> Column:
    return F.coalesce(text.rlike(STRICT_HULL), F.lit(False))


def has_loose_hull(text: Column) -> Column:
    return F.coalesce(text.rlike(LOOSE_HULL), F.lit(False))


def title_has_hull(title: Column) -> Column:
    return has_strict_hull(title) | has_loose_hull(title)


def metadata_has_hull(hull_in_title: Column, image_url: Column, page_url: Column) -> Column:
    """The fast path: a hull number in the title or in either URL."""
    return F.coalesce(hull_in_title, F.lit(False)) | has_strict_hull(image_url) | has_strict_hull(page_url)


def strip_watermarks(text: Column) -> Column:
    """Tokens without watermarks and without numbers of more than six digits.

    Plain substring tests let most tokens pass by the patterns; tokens beyond
    ASCII, where case folds in other ways, always meet them.
    """
    marked = _FLAGS + "(?:" + "|".join(WATERMARKS) + ")"

    def dropped(t: Column) -> Column:
        maybe = F.octet_length(t) != F.length(t)
        for head in _HEADS:
            maybe = maybe | F.lower(t).contains(head)
        return (maybe & t.rlike(marked)) | ((F.length(t) > 6) & t.rlike(r"^\p{Nd}{7,}$"))

    tokens = F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")
    return F.array_join(F.filter(tokens, lambda t: ~dropped(t)), " ")


def digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{Nd}]+", ""))


def letters_and_digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]+", ""))


def fold_tokens(tokens: Column) -> tuple[Column, Column]:
    """(text, confidence) of an array of structs text and conf: joined, and the highest or 0."""
    text = F.trim(F.array_join(F.transform(tokens, lambda t: t["text"]), " "))
    return text, F.greatest(F.coalesce(F.array_max(F.transform(tokens, lambda t: t["conf"])), F.lit(0.0)), F.lit(0.0))


def ocr_accepts(cleaned: Column, min_digits: int = 1, max_chars: int = 15) -> Column:
    return (digits(cleaned) >= min_digits) & (letters_and_digits(cleaned) <= max_chars)


def safe_stem(title: Column, limit: int = 25) -> Column:
    """Lower case of the first characters, others than letters and digits as ``_``, none at the ends."""
    flat = F.regexp_replace(F.lower(F.substring(F.coalesce(title, F.lit("")), 1, limit)), r"[^\p{L}\p{N}]", "_")
    return F.btrim(flat, F.lit("_"))


def _lookup(source: Column, table: dict, default) -> Column:
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.create_map(*pairs)[source], F.lit(default))


def source_prefix(source: Column) -> Column:
    return _lookup(source, SOURCE_PREFIX, "xx")


def source_rank(source: Column) -> Column:
    return _lookup(source, SOURCE_RANK, 9)


def file_stem(source: Column, source_id: Column, title: Column) -> Column:
    safe = safe_stem(title)
    return F.concat_ws("_", source_prefix(source), source_id, F.when(safe == "", source).otherwise(safe))


def clean_title(title: Column) -> Column:
    out = title
    for part in ("File:", ".jpg", ".png"):
        out = F.replace(out, F.lit(part), F.lit(""))
    return out


def is_file_title(title: Column) -> Column:
    return title.startswith("File:")


def pixels(attribute: Column) -> Column:
    """A width or height attribute as a number, null if it is none."""
    return F.trim(F.replace(attribute, F.lit("px"), F.lit(""))).try_cast("int")


def declared_size_ok(width: Column, height: Column, least_width: int = 250, least_height: int = 150) -> Column:
    """Left to right, and what can't be read passes: see the order of the cases."""
    w, h = pixels(width), pixels(height)
    missing = (F.coalesce(width, F.lit("")) == "") | (F.coalesce(height, F.lit("")) == "")
    return F.when(missing, True).when(w.isNull(), True).when(w < least_width, False).when(h.isNull(), True).otherwise(h >= least_height)


def error_status(error_type: Column, message: Column) -> Column:
    """A probe's status from the error's type and text; no error is OK."""
    reset = message.rlike("Connection refused|Connection reset|RemoteDisconnected")
    return (
        F.when(F.coalesce(error_type, F.lit("")) == "", "OK")
        .when(error_type == "ConnectTimeout", "CONNECT_TIMEOUT")
        .when(error_type == "ReadTimeout", "READ_TIMEOUT")
        .when((error_type == "ConnectionError") & F.coalesce(reset, F.lit(False)), "CONN_RESET")
        .when(error_type == "ConnectionError", "CONN_ERROR")
        .otherwise("ERROR")
    )


def speed_kbps(size_kb: Column, elapsed: Column) -> Column:
    """Rounded kilobytes a second; 0 where no time passed."""
    return F.when(elapsed > 0, F.round(size_kb / elapsed)).otherwise(0.0)
