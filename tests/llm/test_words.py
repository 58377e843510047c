import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import words as W

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def fold(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40), max_size=8))
def test_same_words_as_regular_expressions(texts):
    for lexer, want in ((W.ALNUM, [ALNUM.findall(fold(t)) for t in texts]), (W.SPACED, [SPACED.findall(t) for t in texts])):
        got = lexer.words(texts)
        cut = [[] for _ in texts]
        seen = {}
        for r, s, e, h in zip(got.row, got.start, got.end, got.hash, strict=True):
            w = texts[r].encode()[s:e].decode()
            w = fold(w) if lexer is W.ALNUM else w
            cut[r].append(w)
            assert seen.setdefault(w, h) == h
        assert cut == want and len(set(seen.values())) == len(seen)


def test_long_texts_are_cut_between_words(monkeypatch):
    texts = ["ab cd " * 500, None, "x" * 5000 + " y", "", "z"]
    want = W.ALNUM.words(texts)
    monkeypatch.setattr(W, "_SEGMENT", 64)
    got = W.ALNUM.words(texts)
    for a, b in ((want.row, got.row), (want.start, got.start), (want.end, got.end), (want.hash, got.hash)):
        assert (a == b).all()
    assert got.bounds().tolist() == [0, 1000, 1000, 1002, 1002, 1003]


def test_slices_and_prefixes():
    column = pa.array(["drop", "Alpha beta", None, "Alphabet"]).slice(1)
    got = W.lex(W.ALNUM, column, (4,))
    assert got.row.tolist() == [0, 0, 2]
    assert got.prefix[4][0] == got.prefix[4][2] != 0 and got.prefix[4][1] == 0
    assert got.hash[0] == W.ALNUM.hash("ALPHA") != got.hash[2]


def test_shingles():
    got = W.ALNUM.words(["a b c", "a b c d e f", "", "c b a"])
    row, h = W.shingles(got, 5)
    assert row.tolist() == [0, 1, 1, 3] and len(np.unique(h)) == 4
