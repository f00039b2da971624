import html
from html.entities import html5

from pyspark.sql import functions as F

from streetloom.functions import address, text


def test_slashes(one):
    assert one(text.unescape_slashes, ["a\\/b", "a/b", "\\\\/", None], "s string") == ["a/b", "a/b", "\\/", None]


def test_unicode_escapes(one):
    rows = ["caf\\u00e9", "\\ud83d\\ude00", "é caf\\u00e9", "bad \\u12", "plain é", "a\\nb", "a\\nb \\u0041", "\\U0001F600", None]
    want = ["café", "😀", "é café", "bad \\u12", "plain é", "a\\nb", "a\nb A", "😀", None]
    assert one(text.unicode_unescape, rows, "s string") == want


def test_unicode_escapes_of_ascii_text_equal_the_codec(one):
    rows = ["x\\u0041\\x42\\103\\t\\\\ \\'q\\'", "\\u00fc\\u00DF"]
    assert one(text.unicode_unescape, rows, "s string") == [r.encode().decode("unicode_escape") for r in rows]


def test_html_entities(one):
    rows = ["a &amp; b", "a &#038; b", "&eacute;&hearts;", "a & b", "none", None]
    assert one(text.html_unescape, rows, "s string") == [r and html.unescape(r) for r in rows]


def test_all_html_entities(one):
    rows = [f"a &{name} b&{name}x &{name[:-1]}" for name in html5]
    numbers = [*range(300), 0xD7FF, 0xD800, 0xDFFF, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFEFF, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000]
    numbers += [0x1F600, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 10**9, 16**9, 10**30]
    rows += [f"&#{n};&#{n} &#x{n:x};&#X{n:X}z&#000{n};" for n in numbers]
    rows += ["&", "&&", "&;", "&#;", "&#x;", "&#xg", "& amp;", "&ampamp;", "&notit;", "&notin;", "&" + "a" * 40 + ";"]
    rows += ["&lt&gt", "&é;", "&\namp;", "\ud7ff&😀amp;", "&amp;lt;", "a\n&quot\r\n", "&" + "&amp" * 500]
    assert one(text.html_unescape, rows, "s string") == [html.unescape(r) for r in rows]


def test_html_entities_stay_in_the_jvm(spark):
    plan = spark.range(1).select(text.html_unescape(F.col("id").cast("string")))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_whitespace(one):
    rows = ["  a\nb  ", " x ", " \t\n", "", "a  b", None]
    assert one(text.clean_whitespace, rows, "s string") == ["a b", "x", None, None, "a  b", None]


def test_first_run_of_spaces_only(one):
    rows = ["a  b  c", "  a", "ab", "a\nb  c", None]
    assert one(text.collapse_first_space, rows, "s string") == ["a b  c", " a", "ab", "a b  c", None]


def test_blank_to_null(one):
    assert one(text.blank_to_null, ["", "  ", " ", " a ", None], "s string") == [None, None, None, " a ", None]


def test_title_case_equals_python(one):
    rows = ["o'neil road", "HAUPTSTRASSE 5a", "3rd ave", "rue de l'école", "a-b_c"]
    assert one(text.title_case, rows, "s string") == [r.title() for r in rows]


def test_tokens(one):
    assert one(text.tokens, ["a-b, a  c", "--", ""], "s string") == [["a", "b", "c"], [], []]


def test_has_alnum(one):
    assert one(text.has_alnum, [" - ", "x", "5", "ñ", ""], "s string") == [False, True, True, True, False]


def test_split_street(one):
    rows = [
        "12 Main St", "Hauptstr. 5a", "Main St, 7-9", "O'neil road 3", "Main Street", "", None,
        "  10-12 rue X ", "5", "Maple Street 5 12",
    ]
    got = one(lambda s: address.split_street(s), rows, "s string")
    assert [(r["road"], r["house"]) for r in got] == [
        ("Main St", "12"), ("Hauptstr.", "5A"), ("Main St", "7-9"), ("O'Neil Road", "3"),
        ("Main Street", None), (None, None), (None, None), ("Rue X", "10-12"), ("5", None),
        ("Maple Street 5", "12"),
    ]


def test_country_code(one):
    rows = ["DE", "de", "D1", "DEU", None, "de\n", "ÄÖ", ""]
    assert one(address.country_code, rows, "s string") == ["de", "de", None, None, None, "de\n", None, None]


def test_netloc_equals_urlparse(one):
    from urllib.parse import urlparse

    rows = ["http://u@h.org:80/p?q#f", "https://a.b", "//x/y", "no-scheme/path", "", "http:/one", "ftp://h?x"]
    assert one(address.url_netloc, rows, "s string") == [urlparse(u).netloc for u in rows]


def test_address_key_skips_nulls(one):
    import hashlib

    got = one(lambda a, b, c: address.address_key(a, b, c), [("x", None, "y"), (None, None, None)], "a string, b string, c string")
    assert got == [hashlib.md5(b"x,y").hexdigest(), hashlib.md5(b"").hexdigest()]


def test_clean_strings(spark):
    from streetloom.operators.cleaning import clean_strings

    df = spark.createDataFrame([(1, " a\\/b \\u00e9 &amp;\n", "  ")], "id int, x string, y string")
    assert clean_strings(df, ["x", "y"]).collect() == [(1, "a/b é &", None)]
