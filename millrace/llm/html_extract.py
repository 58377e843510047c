"""Main text of web pages by tag-path ratios.

A page is read once into text leaves, each with its path of structural tags from
the root.  Per path the leaves' text length and punctuation are aggregated into
a text ratio and a punctuation ratio a leaf, less the share of text in links.
Both are smoothed over neighbouring leaves by a Gaussian, fused by their product
and held against a threshold of their spread: leaves at or above it are content.

Elements that declare another purpose (by tag, role, class, id or being hidden)
don't delete anything: each on a path scales its ratio by ``ASIDE``.  One that holds
an article, or nearly all text, or half of it with the main heading, is a wrapper
whatever it is called, and scales nothing.

The lowest element with nearly all content is where the article stands.  Its leaves
below the threshold (headings, short lines) belong to it unless they are links or an
aside lies between; content elsewhere must reach the threshold of unsmoothed ratios
too, by its own path and not by its neighbours.

Tags need not be balanced: a block closes an open paragraph, an end tag closes
up to its start, inline formatting is ignored in paths, and a quote that doesn't
close within its tag ends with it.  Elements and paths are numbers, so that memory
follows the page's length, however deep it is nested.

Defined cases: a null page or one without text gives the empty string; every row
is read by itself, so repeated rows agree; an unclosed comment or script runs to
the end; an empty table gives an empty one; extra columns travel inside ``row``.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VALUE = r"""{0}[^{0}<>]*{0}|{0}[^{0}<>]*<[^{0}]*{0}|{0}[^{0}<>]*>[^{0}<]*{0}"""
_TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>{_VALUE.format('"')}|{_VALUE.format("'")}|[^>])*+)(?:>|\Z)""", re.S)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+")

# Elements and names of the markup language, and words by which pages name their parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes object canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
ASIDE_TAGS = frozenset("nav footer aside form button select option datalist dialog menu head fieldset map".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr hidden login masthead "
    "menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion related reply replies respond "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
HEAD_NAMES = frozenset({"header", "head"})
CONTENT_NAMES = frozenset("article articles content entry main post story".split())
MODIFIERS = frozenset("has no with without".split())
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus".split())
NEVER_ASIDE = frozenset({"html", "body", "article", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element on the left ends where one on the right begins.
ENDS = {
    "p": frozenset(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li td th tr dd dt".split()
    ),
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "option": frozenset({"option", "optgroup"}),
} | {h: frozenset() for h in HEADINGS}
PUNCTUATION = re.compile(r"[,.;:!?，。；：！？、]")

#: Neighbouring leaves on either side that smoothing reaches, and its width.
RADIUS, WIDTH = 2, 1.0
#: Threshold as a share of the spread of the fused ratios.
SPREAD = 0.5
#: Share of the selected text that the content element holds.
SHARE = 0.9
#: What an element that declares another purpose leaves of a ratio.
ASIDE = 0.02
#: Shares of all text that is no link from which such an element is a wrapper: alone, and with the main heading.
WRAPS, WRAPS_HEADING = 0.8, 0.5


def declares(tag: str, attributes: str, inside: bool) -> tuple[bool, frozenset[str]]:
    """Whether an element says that it is no content, and the words that name it.  ``inside``: of an article."""
    aside, names = tag in ASIDE_TAGS or (tag == "header" and not inside), frozenset()
    if attributes:
        for name, *values in _NAMED.findall(attributes):
            value = "".join(values).lower()
            if name.lower() == "role":
                aside |= value.strip() in ASIDE_ROLES
            elif tag not in NEVER_ASIDE or tag == "article":
                names |= frozenset(_WORD.findall(value))
                # "has-sidebar" tells of a part, it doesn't name this one
                words = {w for name in value.split() for w in _WORD.findall(name) if MODIFIERS.isdisjoint(_WORD.findall(name))}
                aside |= bool(words & (COMMENT_NAMES if tag == "article" else ASIDE_NAMES)) or bool(words & HEAD_NAMES and not words & CONTENT_NAMES and not inside)
        aside |= tag not in ("html", "body") and bool(_HIDDEN.search(attributes))
    return aside, names


class Page:
    """Elements, by number in page order, and text leaves.  Element 0 is the root."""

    def __init__(self, page: str):
        self.tags, self.parent, self.path, self.aside, self.inside = [""], [-1], [0], [False], [False]
        self.element: list[int] = []
        self.text: list[str] = []
        self.linked: list[int] = []
        self._paths: dict[tuple, int] = {}
        self._read(page)

    def _open(self, tag: str, parent: int, attributes: str) -> int:
        inside = self.inside[parent] or tag in ("article", "main")
        aside, names = declares(tag, attributes, inside)
        self.tags.append(tag)
        self.parent.append(parent)
        self.path.append(self._paths.setdefault((self.path[parent], tag, names), len(self._paths) + 1))
        self.aside.append(aside)
        self.inside.append(inside)
        return len(self.tags) - 1

    def _read(self, page: str) -> None:
        top, link, linked = 0, False, 0
        opened: dict[str, int] = {}
        pieces: list[str] = []

        def flush() -> None:
            nonlocal linked
            if pieces:
                if text := " ".join(html.unescape("".join(pieces)).split()):
                    self.element.append(top)
                    self.text.append(text)
                    self.linked.append(min(linked, len(text)))
                pieces.clear()
            linked = 0

        at, n = 0, len(page)
        while at < n:
            found = _TOKEN.search(page, at)
            body = page[at : found.start()] if found else page[at:]
            if body:
                pieces.append(body)
                if link:
                    linked += len(body)
            if not found:
                break
            at = found.end()
            closing, tag, attributes = found.groups()
            if tag is None:
                continue
            tag = tag.lower()
            if closing:
                if tag == "a":
                    link = False
                if tag in INLINE or tag in VOID or not opened.get(tag):
                    continue
                flush()
                while True:  # an element is left once, so all ends together cost what all starts do
                    opened[self.tags[top]] -= 1
                    last, top = self.tags[top], self.parent[top]
                    if last == tag:
                        break
                link = False
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else n
            elif tag in INLINE:
                link = link or tag == "a"
            elif tag in VOID:
                if tag in ("br", "hr"):
                    flush()
            else:
                flush()
                while top and tag in ENDS.get(self.tags[top], ()):
                    opened[self.tags[top]] -= 1
                    top = self.parent[top]
                if not attributes.rstrip().endswith("/") or tag not in ("path", "g"):
                    top, link = self._open(tag, top, attributes), False
                    opened[tag] = opened.get(tag, 0) + 1
        flush()

    def up(self, values: list) -> list:
        """Each element's value with those of all below it."""
        out = list(values)
        for e in range(len(out) - 1, 0, -1):  # an element follows its parent
            out[self.parent[e]] += out[e]
        return out

    def weights(self) -> list[float]:
        """What the asides on its path leave of each element's ratio."""
        free, heading, article = ([0] * len(self.tags) for _ in range(3))
        for e, text, linked in zip(self.element, self.text, self.linked, strict=True):
            free[e] += len(text) - linked
        for e, tag in enumerate(self.tags):
            heading[e] = tag == "h1"
            article[e] = tag in ("article", "main") and not self.aside[e]
        free, heading, article = self.up(free), self.up(heading), self.up(article)
        out = [1.0] * len(self.tags)
        for e in range(1, len(out)):
            wraps = article[e] or free[e] >= WRAPS * free[0] or (heading[e] and free[e] >= WRAPS_HEADING * free[0])
            out[e] = max(out[self.parent[e]] * (ASIDE if self.aside[e] and not wraps else 1.0), 1e-12)
        return out


def ratios(page: Page) -> tuple[list[float], list[float], list[float]]:
    """Per leaf: its path's text ratio and punctuation ratio, and the share of its path's text that is no link."""
    sums: dict[int, list[int]] = {}
    for e, text, linked in zip(page.element, page.text, page.linked, strict=True):
        total = sums.setdefault(page.path[e], [0, 0, 0, 0])
        for i, x in enumerate((1, len(text), len(PUNCTUATION.findall(text)), linked)):
            total[i] += x
    own = [sums[page.path[e]] for e in page.element]
    free = [1 - s[3] / s[1] for s in own]
    return [s[1] / s[0] * f for s, f in zip(own, free, strict=True)], [(1 + s[2]) / s[0] * f for s, f in zip(own, free, strict=True)], free


def smooth(values: list[float]) -> list[float]:
    weights = [math.exp(-(d * d) / (2 * WIDTH * WIDTH)) for d in range(-RADIUS, RADIUS + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for d, w in zip(range(-RADIUS, RADIUS + 1), weights, strict=True):
            if 0 <= i + d < len(values):
                total, weight = total + w * values[i + d], weight + w
        out.append(total / weight)
    return out


def threshold(fused: list[float]) -> float:
    mean = sum(fused) / len(fused)
    return min(SPREAD * math.sqrt(sum((x - mean) ** 2 for x in fused) / len(fused)), max(fused))


def _article(page: Page, chosen: list[bool], weight: list[float]) -> int:
    """The element where the content stands."""
    mass, head = [0.0] * len(page.tags), [0] * len(page.tags)
    for e, text, own in zip(page.element, page.text, chosen, strict=True):
        if own:
            mass[e] += len(text) * weight[e]
        head[e] += own or page.tags[e] in HEADINGS
    mass = page.up(mass)
    at = max(e for e in range(len(mass)) if mass[e] >= SHARE * mass[0])  # those with so much lie on one path
    line = [at]
    while line[-1]:
        line.append(page.parent[line[-1]])
    for e in line:  # the article that holds it, with its heading
        if page.tags[e] in ("article", "main"):
            return e
    # up to the highest element below body where selected text or a heading stands beside it, in no aside
    head = page.up(head)
    best = at
    for low, high in zip(line[:-1], line[1:], strict=True):
        if page.tags[high] in ("", "html", "body") or weight[high] > weight[low]:
            break
        if head[high] > head[low]:
            best = high
    return page.parent[best] if page.tags[best] == "p" or page.tags[best] in HEADINGS else best


def main_text(html_page: str | None) -> str:
    """The content of a page, blocks joined by a space."""
    page = Page(html_page or "")
    if not page.text:
        return ""
    text, marks, free = ratios(page)
    weight = page.weights()
    scale = [weight[e] for e in page.element]
    fused = [a * b * w for a, b, w in zip(smooth(text), smooth(marks), scale, strict=True)]
    least = threshold(fused)
    plain = [f >= 0.5 for f in free]
    chosen = [x >= least and f for x, f in zip(fused, plain, strict=True)]
    if not any(chosen):
        chosen = plain
    if not any(chosen):
        return ""
    article = _article(page, chosen, weight)
    within = [False] * len(page.tags)
    for e in range(article, len(within)):
        within[e] = e == article or within[page.parent[e]]
    own = [a * b * w for a, b, w in zip(text, marks, scale, strict=True)]
    elsewhere = threshold(own)
    out = []
    for i, e in enumerate(page.element):
        if within[e]:
            good = weight[e] >= weight[article] and (plain[i] or page.linked[i] < len(page.text[i]) / 2)
        else:
            good = chosen[i] and own[i] >= elsewhere
        if good:
            out.append(page.text[i])
    return " ".join(out)


def extract(df: DataFrame, page: str = "html") -> DataFrame:
    """``row``, the input row as a struct, and ``text``, its page's main text."""
    field = df.columns.index(page)
    rows = df.select(F.struct("*").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = pc.struct_field(batch.column(0), [field])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([main_text(p.as_py()) for p in pages], pa.string())], names=["row", "text"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())]))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
