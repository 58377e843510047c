import random
from itertools import combinations

from millrace.llm import license_scan as C


def test_increasing_is_longest():
    rng = random.Random(1)
    for _ in range(200):
        ys = [rng.randrange(12) for _ in range(rng.randrange(9))]
        pairs = list(enumerate(ys))
        got = C._increasing(pairs)
        assert all(a < b and x < y for (a, x), (b, y) in zip(got, got[1:], strict=False))
        best = max((len(s) for k in range(len(ys) + 1) for s in combinations(ys, k) if all(a < b for a, b in zip(s, s[1:], strict=False))), default=0)
        assert len(got) == best


def test_patience_matches_are_equal_and_rise():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(8) for _ in range(rng.randrange(15))] for _ in range(2))
        got = C.patience(a, b)
        assert all(a[i] == b[j] for i, j in got) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
    assert C.patience(list("abcde"), list("xbcdy")) == [(1, 1), (2, 2), (3, 3)]


def test_every_template_is_found_whole(prose):
    scanner = C.Scanner()
    texts = [f"{prose(i, 60)} the and of {body.upper()} to the {prose(i + 100, 60)}" for i, (_, body) in enumerate(C.TEMPLATES)]
    for (name, body), own in zip(C.TEMPLATES, scanner.scan(C.ALNUM.words(texts)), strict=True):
        assert [(n, c) for _, _, n, c in own] == [(name, 1.0)], body


def test_edits_and_near_templates(prose):
    mit = C.TEMPLATES[2][1].split()
    mit[20] = mit[50] = "changed"
    texts = [" ".join(mit), "Licensed under CC BY-NC 4.0. Released under the MIT License. Licensed under CC BY-NC 4.0.", " ".join(mit[:60]), "the license of the work is the license of the public and this is under the version"]
    found = C.Scanner().scan(C.ALNUM.words(texts))
    assert [(n, round(c, 2)) for _, _, n, c in found[0]] == [("MIT", round(1 - 2 / len(C.ALNUM.words([C.TEMPLATES[2][1]]).hash), 2))]
    assert [n for _, _, n, _ in found[1]] == ["CC-BY-NC-4.0", "MIT", "CC-BY-NC-4.0"]
    assert found[2] == [] == found[3]


def test_query(spark, make, odd, prose, sf_of):
    rows = [*odd, (1, f"ü {prose(1, 50)}.\nReleased under the MIT License."), (2, prose(2, 90)), (3, "Released under the MIT License. " * 3000)]
    df = make(rows)
    got = {r.doc_id: r for r in C.op10_license_scan(spark, sf_of(documents=df)).collect()}
    assert (got[1].licenses, got[1].n_matches, got[1].coverage, got[1].n_words) == ("MIT", 1, 1.0, 5)
    assert (got[2].licenses, got[2].n_matches, got[2].coverage, got[2].n_words) == ("", 0, 0.0, 0)
    assert got[3].n_matches == 3000 and all(got[i].n_matches == 0 for i, _ in odd)
    clash = df.selectExpr("*", "1 AS licenses", "2 AS row")
    found = C.scan(clash)
    assert found.select("row.*").columns == clash.columns and C.scan(clash.filter("false")).count() == 0
    (m,) = found.filter("row.doc_id = 1").first().licenses
    assert rows[-3][1].encode()[m.start : m.end].decode() == "Released under the MIT License"


def test_licenses_outside_the_table(prose):
    notices = [
        "Licensed under the BSD License.",
        "Licensed under the Apache License.",
        "Licensed under the Apache License, Version 1.1.",
        "Licensed under CC BY 3.0.",
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution 3.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
    ]
    texts = [f"{prose(i, 40)} {n} {prose(i + 50, 40)}" for i, n in enumerate(notices)]
    for n, own in zip(notices, C.Scanner().scan(C.ALNUM.words(texts)), strict=True):
        assert own == [], n
    (own,) = C.Scanner().scan(C.ALNUM.words(["It was released under MIT License"]))
    assert [n for _, _, n, _ in own] == ["MIT"]
