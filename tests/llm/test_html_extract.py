import html
import re

import pytest

from millrace.llm import html_extract as H


def article(page):
    """What the generated pages hold between article tags."""
    body = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", page, re.S)[1])
    blocks = (" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]+>", body))
    return " ".join(x for x in blocks if x)


def test_generated_pages(spark, sf):
    got = {r.page_id: r for r in H.op5_html_extract(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == article(p.html) and got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


LONG = "A long paragraph, with commas, and more than one sentence. It goes on, and on, until it ends."
CASES = {
    f"<div class='menu'><a href=x>Home</a></div><div id=content><h1>Title</h1><p>{LONG}<p>Short.</div><div class='sidebar'><p>{LONG}</p></div>": f"Title {LONG} Short.",
    f"<body class='has-sidebar'><header><p>Site</header><main><p>{LONG}</p><section id='comments'><p>I agree, {LONG}</section></main><footer>f": LONG,
    f"<article><header><h1>T</h1></header><p>{LONG}</p><div class='related'><p>{LONG}</div><aside>x, y</aside><form><p>Sign, up</form></article>": f"T {LONG}",
    f"<div hidden><p>{LONG}</div><div style='display: none'>{LONG}</div><div role=banner>x</div><article><p>{LONG}</article>": LONG,
    f"<article><p>{LONG}</p><script>var a='</p><p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> --><p>a&amp;b&nbsp;c &lt;d&gt; &#233;</p></article>": f"{LONG} a&b c <d> é",
    "<p>a<b>b</b>c<br>d\n e</p>": "abc d e",
    "plain text": "plain text",
    f"<div class='cookie-notice'>{LONG}</div><div class='ad'>{LONG}</div><article><ul><li>one, two</li><li>three</ul><table><tr><td>x<td>y</table></article>": "one, two three x y",
}


@pytest.mark.parametrize("page", list(CASES))
def test_cases(page):
    assert H.main_text(page) == CASES[page]


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "<div>" * 3000 + "deep"), (4, "u", "<p>" + "word, " * 100_000), (5, "u", "<script>x"), (5, "u", "<script>x"), (6, "u", "</p></div><<>< a"), (None, None, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS row")
    got = H.extract(df).collect()
    assert len(got) == len(rows) and all(r.text is not None for r in got)
    by = {r.row.page_id: r.text for r in got}
    assert by[1] == by[2] == by[5] == "" and by[3] == "deep" and by[4].startswith("word, word,") and len(by[4]) == 599_999 and by[None] == "t"
    assert H.extract(df.filter("false")).count() == 0


@pytest.mark.parametrize("name", ["site has-sidebar", "content no-sidebar", "page with-widgets", "without-ads"])
def test_names_that_tell_of_a_part(name):
    assert H.main_text(f"<div class='{name}'><article><p>{LONG}</p></article><div class='sidebar'><p>{LONG}</p></div></div>") == LONG


def test_heading_and_lead_beside_the_text():
    body = " ".join([LONG] * 20)
    page = f"<body><div class='menu'><a href=x>Home</a></div><div><h1>Title</h1><div class=lead><p>A lead, short.</p></div><div class=text><p>{body}</p></div></div><div class='ad'>{LONG}</div></body>"
    assert H.main_text(page) == f"Title A lead, short. {body}"


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='page has-sidebar'><article><p>{LONG}</p></article></div>",
        f"<div class='elementor-widget-container'><p>{LONG}</p></div>",
        f"<form action=x><div id=content><p>{LONG}</p></div></form>",
        f"<div id='wrap' class='no-social'><main><p>{LONG}</p></main></div>",
        f"<fieldset><div><h1></h1><p>{LONG}</p></div></fieldset><div class=ad>Buy.</div>",
        f"<div class='widget'><article><p>{LONG}</p></article></div><div class='comments'><article class='comment-body'><p>{LONG}</p></article></div>",
    ],
)
def test_wrappers_keep_their_article(page):
    assert H.main_text(page) == LONG


@pytest.mark.parametrize("stray", ["<p title=\"it's>", "<p title='a\"b>", "<p title=\"x>", "<p data-x=\"<b>it's</b>\">", "<p title='1 > 0'>"])
def test_stray_quotes(stray):
    assert H.main_text(f"<article><p>{LONG}</p>{stray}{LONG}</p><b class=\"x\">{LONG}</b></article>") == " ".join([LONG] * 3)


def test_long_comments_do_not_win():
    comments = "".join(f"<li class='comment'><p>{LONG} {LONG}</li>" for _ in range(9))
    assert H.main_text(f"<div><h1>Title</h1><p>{LONG}</p><p>{LONG}</p><ol id='comments'>{comments}</ol></div>") == f"Title {LONG} {LONG}"


def test_ratios_equal_a_count():
    page = H.Page(f"<body><div class=a><p>{LONG}<p>x, y</p><p><a href=z>all link</a></p></div><div class=b><p>no</p></div></body>")
    text, marks, free = H.ratios(page)
    blocks = [LONG, "x, y", "all link"]
    share = 1 - len("all link") / sum(map(len, blocks))
    count = sum(b.count(c) for b in blocks for c in ",.;:!?")
    assert text == [pytest.approx(sum(map(len, blocks)) / 3 * share)] * 3 + [2.0]
    assert marks == [pytest.approx((1 + count) / 3 * share)] * 3 + [1.0] and free[:3] == [pytest.approx(share)] * 3
    values = [1.0, 5.0, 2.0, 8.0]
    g = [1, 2.718281828459045**-0.5, 2.718281828459045**-2]
    want = [sum(g[abs(i - j)] * v for j, v in enumerate(values) if abs(i - j) < 3) / sum(g[abs(i - j)] for j in range(4) if abs(i - j) < 3) for i in range(4)]
    assert H.smooth(values) == pytest.approx(want)


def test_the_threshold_decides(spark, sf, monkeypatch):
    """Without it advertisements and footers come in; without any names paths still tell the article."""
    pages = [p.html for p in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert all(H.main_text(p) == article(p) for p in pages)
    bare = [p.replace("article>", "div>") for p in pages]
    assert all(H.main_text(b) == article(p) for b, p in zip(bare, pages, strict=True))
    monkeypatch.setattr(H, "threshold", lambda fused: -1.0)
    assert sum(H.main_text(p) != article(p) for p in pages) > len(pages) / 2


def test_memory_follows_the_length():
    import tracemalloc

    tracemalloc.start()
    assert H.main_text("<div>" * 200_000 + LONG) == LONG
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
