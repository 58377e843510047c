import re

from millrace.functions import text


def test_hull_patterns_like_python(column):
    strict = re.compile(r"\b(?:" + "|".join(text.HULL_PREFIXES) + r")[-\s]?\d{1,4}\b", re.I)
    loose = re.compile(r"\b\d{2,4}\b.*(?:" + "|".join(text.VESSEL_WORDS) + ")", re.I)
    cases = ["USS DDG-51", "ddg 1000 x", "xDDG-51", "DDG-51234", "éDD-1", "DD١", "ſS1", "12 frigate", "123\nfrigate", "12 a\rfrigate", "12 cruiser", "1 carrier", "", "CVN\t70"]
    assert column(text.has_strict_hull, cases) == [bool(strict.search(c)) for c in cases]
    assert column(text.has_loose_hull, cases) == [bool(loose.search(c)) for c in cases]
    assert column(text.title_has_hull, [None]) == [False]


def test_strip_watermarks(column):
    cases = {
        "DDG 51 www.site.com 1234567 123456": "DDG 51 123456",
        "a b\tc": "a b c",
        "Photo by X ©2020 (c)Y": "Photo by X",
        "image 12345.jpg usni": "",
        "ſource CREDITS http://x WWW.a.MIL (C)x ©x ٠١٢٣٤٥٦ kept": "kept",
        "": "",
    }
    assert column(text.strip_watermarks, list(cases)) == list(cases.values())


def test_ocr(column):
    assert column(text.digits, ["a1٢b", ""]) == [2, 0]
    assert column(text.letters_and_digits, ["a-1 ü", ""]) == [3, 0]
    assert column(text.ocr_accepts, ["51", "abc", "DDG51 and much more text", ""]) == [True, False, False, False]


def test_fold(spark):
    df = spark.createDataFrame([([("a", 0.5), ("b", 0.75)],), ([],), (None,)], "t array<struct<text:string,conf:double>>")
    body, conf = text.fold_tokens(df.t)
    assert [tuple(r) for r in df.select(body, conf).collect()] == [("a b", 0.75), ("", 0.0), (None, 0.0)]


def test_declared_size(column):
    cases = {
        ("", "100"): True, (None, "1"): True, ("auto", "10"): True, ("249", "x"): False, ("250px", "x"): True,
        ("250", "149px"): False, ("250", "150"): True, ("300", ""): True,
    }
    assert column(text.declared_size_ok, list(cases), "a string, b string") == list(cases.values())


def test_stems(column):
    assert column(text.safe_stem, ["USS Example (DDG-51) at sea, 1999", "ünï", "", None, "---"]) == ["uss_example__ddg_51__at_s", "ünï", "", "", ""]
    assert column(text.file_stem, [("bing", "x", "A b"), ("odd", "y", "")], "a string, b string, c string") == ["bi_x_a_b", "xx_y_odd"]
    assert column(text.clean_title, ["File:A.jpg.png"]) == ["A"]
    assert column(text.source_rank, ["bing", "other", None]) == [1, 9, 9]


def test_probes(column):
    cases = [(None, ""), ("ConnectTimeout", ""), ("ReadTimeout", ""), ("ConnectionError", "Connection reset by peer"), ("ConnectionError", None), ("SSLError", "")]
    assert column(text.error_status, cases, "a string, b string") == ["OK", "CONNECT_TIMEOUT", "READ_TIMEOUT", "CONN_RESET", "CONN_ERROR", "ERROR"]
    assert column(text.speed_kbps, [(100.0, 4.0), (1.0, 0.0)], "a double, b double") == [25.0, 0.0]
