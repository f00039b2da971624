import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from streetloom.functions import jsonld

T = '<script type="application/ld+json">{}</script>'

PAGES = [
    (T.format("a") + "<p>" + T.format("b"), ["a", "b"]),
    (T.format(""), []),
    ("<!-- " + T.format("no") + " -->" + T.format("yes"), ["yes"]),
    ("<script type=application/ld+json>u</script>", ["u"]),
    ("<script type='application/ld+json'>s</script>", ["s"]),
    ('<script type="application/ld+json; charset=utf-8">p</script>', []),
    ('<script type="APPLICATION/LD+JSON">c</script>', []),
    ('<SCRIPT TYPE="application/ld+json" >upper</SCRIPT >', ["upper"]),
    ('<script async id="x" data-a=\'type="q"\' type="application/ld+json">later</script>', ["later"]),
    ('<script data-type="application/ld+json">no</script>', []),
    ('<script>var s = "<script type=\'application/ld+json\'>";</script>' + T.format("r"), ["r"]),
    (T.format("<!-- inner -->x"), ["<!-- inner -->x"]),
    ('<script type="application/ld&#43;json">entity</script>', ["entity"]),
    ('<scripty type="application/ld+json">no</scripty>', []),
    ("no script", []),
    ('<div title="<!--">x</div>' + T.format("attribute"), ["attribute"]),
    ('<style>p::before{content:"<!--"}</style>' + T.format("style"), ["style"]),
    ("<textarea><!-- </textarea>" + T.format("area"), ["area"]),
    ("<!-->" + T.format("short") + "<!--->" + T.format("shorter"), ["short", "shorter"]),
    ("<script data-x=it's type=application/ld+json>quote</script>", ["quote"]),
    ("<a title=\"<script type='application/ld+json'>no</script>\">" + T.format("title"), ["title"]),
    ("1 < 2 </ 3 <> <![odd x]> <!doctype html>" + T.format("text"), ["text"]),
    (T.format("open") + "<a href='x", ["open"]),
    (T.format("ended") + "<!-- " + T.format("no"), ["ended"]),
    (None, None),
]


def test_script_texts(one):
    got = one(jsonld.script_texts, [p for p, _ in PAGES], "page string")
    assert got == [w for _, w in PAGES]


def test_parser_finds_the_same(one):
    got = one(jsonld.script_texts_parsed, [p for p, _ in PAGES], "page string")
    assert got == [w for _, w in PAGES]


def test_large_page_does_not_overflow(one):
    page = "<script>" + "x<" * 200_000 + "</script>" + T.format("z") + "<!--" * 50_000
    assert one(jsonld.script_texts, [page], "page string") == [["z"]]
    page = "<p class='a'>t</p>" * 50_000 + T.format("z") + "<a b=" * 100_000 + "<script " * 50_000
    assert one(jsonld.script_texts, [page], "page string") == [["z"]]


JSONS = [
    '{"a":1}', '{"a":1} xx', '{"a":1,"a":2}', '"x"', "5", "null", "", " ", "[1,2]", "1,2", "1] x", '{"a":"x\ty"}',
    '{"a":1}}', '"a","b"', " [1] ", "{", "01", "+1", '{"a":tru}', '1,"x"]', '{"s":"NaN, Infinity"}', "nope",
    '{"a":"\\u00e9"}', '{"a":1,}', "{'a':1}", "﻿{}", "[[[]]]",
]


@pytest.mark.parametrize("text", JSONS)
def test_parse_accepts_what_python_accepts(one, text):
    try:
        want = json.loads(text)
        valid = True
    except ValueError:
        valid = False
    got = one(lambda t: F.to_json(jsonld.parse_json(t)), [text], "t string")[0]
    assert (got is not None) == valid
    if valid:
        assert json.loads(got) == want


def test_number_words(one):
    rows = ['{"a":NaN,"b":"NaN"}', "[-Infinity, Infinity]", '{"a":NaNx}']
    got = one(lambda t: F.to_json(jsonld.parse_json(t)), rows, "t string")
    assert [g and json.loads(g) for g in got] == [{"a": "nan", "b": "NaN"}, ["-inf", "inf"], None]


def test_is_json(one):
    assert one(jsonld.is_json, ['{"a":1}', "<html>", ' "x"', "[1", None], "t string") == [True, False, True, False, False]


def tree(rng, depth):
    kind = rng.randrange(4 if depth else 2)
    if kind == 0:
        return rng.choice([None, True, "t", 3, 1.5, ""])
    if kind == 1:
        return rng.randrange(10)
    if kind == 2:
        return [tree(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {f"k{i}": tree(rng, depth - 1) for i in range(rng.randrange(4))}


def test_sub_objects_equal_recursion(one):
    rng = random.Random(1)
    trees = [tree(rng, 5) for _ in range(60)]
    deep = {"d": 0}
    for _ in range(120):
        deep = {"n": [deep]}
    trees.append(deep)
    got = one(
        lambda t: F.transform(jsonld.sub_objects(jsonld.parse_json(t)), lambda o: F.to_json(o)),
        [json.dumps(t) for t in trees],
        "t string",
    )

    def bag(objects):
        return sorted(json.dumps(o, sort_keys=True) for o in objects)

    con = duckdb.connect()
    for t, g in zip(trees, got, strict=True):
        sql = "select value::varchar from json_tree(?::json) where type = 'OBJECT'"
        want = con.execute(sql, [json.dumps(t)]).fetchall()
        assert bag(map(json.loads, g)) == bag(json.loads(w) for (w,) in want)


def test_sub_objects_of_few_trees(one):
    rows = ['{"a":[{"b":1},2]}', "[[{}]]", '{"a":{"a":{}}}', "3"]
    got = one(
        lambda t: F.transform(jsonld.sub_objects(jsonld.parse_json(t)), lambda o: F.to_json(o)), rows, "t string"
    )
    want = [['{"a":[{"b":1},2]}', '{"b":1}'], ["{}"], ['{"a":{"a":{}}}', '{"a":{}}', "{}"], []]
    assert [sorted(g) for g in got] == [sorted(w) for w in want]


@pytest.mark.parametrize(
    "text, wanted",
    [
        ('{"address":{"@type":"PostalAddress"}}', True),
        ('{"address":[{"@type":"PostalAddress"}]}', False),
        ('{"address":{"@type":["PostalAddress"]}}', False),
        ('{"address":{"@type":"postaladdress"}}', False),
        ('{"address":"PostalAddress"}', False),
        ("{}", False),
    ],
)
def test_postal_address(one, text, wanted):
    assert one(lambda t: jsonld.has_postal_address(F.parse_json(t)), [text], "t string") == [wanted]


VALUES = [
    "null", '""', '"  "', '"x"', "5", "5.0", "1.50", "-0.25", "1e5", "12345678", "12345678.5", "true", "false",
    "12345678901234567890123", '{"name":"A"}', '{"name":{"name":"B"}}', "{}", "[]", '["a",null,{"name":"b"}]',
    '[["a",["b"]],"",7,{"name":[]}]', '{"name":[]}', '{"name":[{"name":"q"}]}', '{"x":1}', '["  ","y"]', "[{}]",
    '{"name":{"name":{"name":{"name":{"name":"deep"}}}}}',
]


# The texts of VALUES in order where blank text is null; where it is kept, three differ.
TEXTS = [
    None, None, None, "x", "5", "5.0", "1.5", "-0.25", "100000.0", "12345678", "12345678.5", "True", "False",
    "12345678901234567890123", "A", "B", None, "", "a, b", "a, b, 7", "", "q", None, "y", "", "deep",
]
KEPT_BLANKS = {1: "", 2: "  ", 23: "  , y"}


@pytest.mark.parametrize("blank_as_null", [True, False])
def test_value_text(one, blank_as_null):
    got = one(lambda t: jsonld.value_text(F.parse_json(t), blank_as_null), VALUES, "t string")
    assert got == [t if blank_as_null else KEPT_BLANKS.get(i, t) for i, t in enumerate(TEXTS)]


def test_falsy(one):
    rows = ["null", '""', "0", "0.0", "-0.0", "false", "[]", "{}", '" "', "1", "[0]", '{"a":1}']
    got = one(lambda t: jsonld.is_falsy(F.parse_json(t)), rows, "t string")
    assert got == [not json.loads(r) for r in rows]
