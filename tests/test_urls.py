from urllib.parse import quote, urljoin

from millrace.functions import urls


def test_canonical(column):
    cases = {
        "http://h/a.jpg": "http://h/a.jpg",
        "HTTP://Host/A.jpg?x=1#f": "http://Host/A.jpg",
        "http://h/p;1/a.jpg;v=2?q": "http://h/p;1/a.jpg",
        "http://h/A_TN.jpg": "http://h/a.jpg",
        "http://h/A_tn.b_tn.jpg": "http://h/a.b.jpg",
        "http://h/a_small.b_tn.jpg": "http://h/a_small.b.jpg",
        "http://h/a-thumbnail.JPG": "http://h/a.jpg",
        "http://h/a_thumb.png?x=_tn.": "http://h/a.png",
        "rel/a.jpg#x": "rel/a.jpg",
        "": "",
        None: None,
    }
    assert column(urls.canonical, list(cases)) == list(cases.values())


def test_resolve_equals_urljoin(column):
    bases = ["http://h.org/a/b/c.htm?x=1#f", "https://h.org", "http://h.org/dir/"]
    links = ["d.htm", "/d.htm", "//o.org/x", "?y=2", "#z", "../d.htm", "./e/./f", "../../../g", "http://o.org/a", "mailto:x@y", "a/../b/", "e f/ü.htm", "", "/a/../b", ".."]
    rows = [(b, x) for b in bases for x in links]
    got = column(urls.resolve, rows, "a string, b string")
    # white box: where there is nothing to resolve the page itself, with its fragment, stays
    assert [(r, g) for r, g in zip(rows, got, strict=True) if g != urljoin(*r)] == []


def test_percent_encode(column):
    texts = ["a b/c~d", "100%*+", "ü&=?", "x'()!,;"]
    assert column(urls.percent_encode, texts) == [quote(t) for t in texts]


def test_host(column):
    assert column(urls.host, ["http://U:p@Ex.org:80/x", "https://a.b?c", "nothing", None]) == ["ex.org:80", "a.b", "", None]


def test_rules(column):
    ship = {"http://m/pages/uss_a.htm": True, "http://m/pages/index.htm": False, "http://m/misc_ships/index1.html": True, "http://m/uss_a.jpg": False, "http://m/x.htm": False}
    assert column(urls.is_ship_page, list(ship)) == list(ship.values())
    assert column(urls.is_blocked_domain, ["http://X.Alamy.com/a", "http://h/a"]) == [True, False]
    assert column(urls.is_bad_keyword, ["http://h/bitmap.jpg", "http://h/MAP", "http://h/x"]) == [True, True, False]
    assert column(lambda c: urls.has_picture_extension(c, "navsource"), ["a.GIF", "a.jpg?x", "a.webp"]) == [True, False, True]
    assert column(lambda c: urls.has_picture_extension(c, "maritimequest"), ["a.GIF"]) == [False]
    assert column(urls.is_section_page, ["http://n/archives/05/1.htm", "http://n/archives/03/1.htm"]) == [True, False]
