"""Misspelt names against a comparison of all texts."""

import random

from streetloom.functions.similarity import edit_distance, one_edit
from streetloom.operators import geocode, misspelt


def spoilt(rng, text, edits):
    letters = list(text)
    for _ in range(edits):
        i = rng.randrange(len(letters))
        kind = rng.randrange(4)
        if kind == 0 and len(letters) > 1:
            del letters[i]
        elif kind == 1:
            letters.insert(i, rng.choice("abcé"))
        elif kind == 2:
            letters[i] = rng.choice("abcé")
        elif i + 1 < len(letters):
            letters[i], letters[i + 1] = letters[i + 1], letters[i]
    return "".join(letters)


def some_texts(rng):
    """Texts of few letters, many near each other, around the border of the two ways."""
    known = {"".join(rng.choices("abcé", k=rng.choice([1, 2, 3, 5, 9, 18, 19, 20, 21, 22, 23, 40]))) for _ in range(160)}
    known |= {spoilt(rng, t, rng.randint(1, 3)) for t in sorted(known)}
    asked = {spoilt(rng, t, rng.randint(0, 3)) for t in sorted(known)} | {"a", "ab", "zz"}
    return sorted(asked), sorted(known)


def test_no_near_pair_is_lost(spark):
    asked, known = some_texts(random.Random(3))
    texts = spark.createDataFrame([(t,) for t in asked], "text string")
    keys = misspelt.known_keys(spark.createDataFrame([(t,) for t in known], "match string"))
    got = {tuple(r) for r in misspelt.near_texts(texts, keys).collect()}
    want = {(a, b, edit_distance(a, b)) for a in asked for b in known if edit_distance(a, b) <= 2}
    assert got == want
    assert len({a for a, b, _ in want if len(a) > 20}) > 50


def test_read_misspelt_keeps_all_rows(spark):
    rows = [("Sprinfield", 1), ("Sprinfield", 1), ("SPRING-FIELD", 2), (None, 3), ("--", 4), ("Oslo", 5),
            ("Olso", 6), ("Oso", 7), ("x" * 5000, 8), ("Nowhere", 9)]
    df = spark.createDataFrame(rows, "town string, edits int").withColumnRenamed("edits", "read_as")
    known = spark.createDataFrame([("Springfield",), ("Spring Field",), ("oslo",), (None,), ("",), ("x" * 4999,)], "t string")
    got = misspelt.read_misspelt(df, "town", known, "t")
    assert sorted(got.columns) == ["edits", "read_as", "town"]
    found = sorted((r["town"] or "", r["read_as"], r["edits"]) for r in got.collect())
    assert found == sorted([
        ("Sprinfield", "springfield", 1), ("Sprinfield", "springfield", 1), ("SPRING-FIELD", "spring field", 0),
        ("", None, None), ("--", None, None), ("Oslo", "oslo", 0), ("Olso", "oslo", 1), ("Oso", None, None),
        ("x" * 5000, "x" * 4999, 1), ("Nowhere", None, None),
    ], key=lambda r: r[0])
    assert misspelt.read_misspelt(df, "town", known.limit(0), "t").where("read_as is null").count() == len(rows)
    assert misspelt.read_misspelt(df.limit(0), "town", known, "t").count() == 0


def test_near_texts_meet_by_key_only(spark):
    df = spark.createDataFrame([("a",)], "text string")
    keys = misspelt.known_keys(spark.createDataFrame([("b",)], "match string"))
    plan = misspelt.near_texts(df, keys)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_one_edit(one):
    rows = [("ab", "ba"), ("abc", "abd"), ("abc", "abcd"), ("abc", "abc"), ("abcd", "badc"), ("ab", "cd"), ("", "a"),
            ("aab", "aba"), ("abc", "cba")]
    assert one(one_edit, rows, "a string, b string") == [True, True, True, False, False, False, True, True, False]


def test_look_up_of_a_misspelt_town(spark):
    places = spark.createDataFrame(
        [(1, None, "5", "Main Street", None, "Springfield", None, "Land", "la"), (2, None, "5", "Main Street", None, "Oslo", None, "Land", "la")],
        "place_id long, name string, house_number string, road string, postcode string, locality string, region string, country string, country_code string",
    )
    queries = spark.createDataFrame(
        [(1, None, "Main Street 5", "Sprignfield", None, None, None), (2, None, "Main Street 5", "Oslo", None, None, None),
         (3, None, "Main Street 5", "Bergen", None, None, None)],
        "n int, name string, street string, city string, postalcode string, country string, state string",
    )
    plain = {r["n"]: r["place_id"] for r in geocode.geocode(queries, places).collect()}
    read = misspelt.correct_towns(queries, places)
    assert read.columns == queries.columns
    better = {r["n"]: r["place_id"] for r in geocode.geocode(read, places).collect()}
    assert plain == {1: None, 2: 2, 3: None} and better == {1: 1, 2: 2, 3: None}
