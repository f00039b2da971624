import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from streetloom.functions import similarity as sim
from streetloom.operators import errors


def words(seed, n, alphabet="abc", longest=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_edit_distance():
    con = duckdb.connect()
    assert sim.edit_distance("ca", "abc") == 2
    for a, b in zip(words(1, 400), words(2, 400)):
        want = con.execute("select damerau_levenshtein(?, ?)", [a, b]).fetchone()[0]
        assert sim.edit_distance(a, b) == want, (a, b)


def test_within_two_edits_is_exact(one):
    rng = random.Random(3)
    pairs = list(zip(words(4, 1500), words(5, 1500)))
    for w in words(6, 1500, "abcdefgh", 12):
        edited = list(w)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(edited) + 1)
            action = rng.randrange(4)
            if action == 0:
                edited.insert(i, rng.choice("abcdefgh"))
            elif i + 1 < len(edited) and action == 1:
                edited[i], edited[i + 1] = edited[i + 1], edited[i]
            elif i < len(edited):
                edited[i : i + 1] = [] if action == 2 else rng.choice("abcdefgh")
        pairs.append((w, "".join(edited)))
    pairs += [("ca", "abc"), ("", "ab"), ("", "abc"), ("", "")]
    got = one(lambda a, b: sim.within_two_edits(a, b), pairs, "a string, b string")
    want = [sim.edit_distance(a, b) <= 2 for a, b in pairs]
    assert [p for p, g, w in zip(pairs, got, want) if g != w] == []
    assert 100 < sum(want) < len(pairs) - 100


def test_within_two_edits_on_long_texts(one):
    long = "abcdefghij" * 2_000
    rows = [
        ("xy" + long + "pq", "yx" + long + "qp"),
        ("xy" + long + "p", "yx" + long),
        (long + "xy" + long, "q" + long + "yx" + long),
        ("xy" + long + "pq" + long, "yx" + long + "qp" + long + "z"),
    ]
    got = one(lambda a, b: sim.within_two_edits(a, b), rows, "a string, b string")
    assert got == [True, True, True, False]


def test_nearest_is_exact(one):
    rng = random.Random(7)

    def maybe(w):
        return rng.choice([None, "", w, w, w])

    rows = [
        tuple(maybe(w) for w in ws)
        for ws in zip(words(8, 800), words(9, 800), words(10, 800), words(11, 800), words(12, 800))
    ]

    got = one(
        lambda q, a, b, c, d: sim.nearest_candidate(q, [a, b], [c, d]),
        rows,
        "q string, a string, b string, c string, d string",
    )
    con = duckdb.connect()
    con.execute("create table t (n int, q varchar, a varchar, b varchar, c varchar, d varchar)")
    con.executemany("insert into t values (?, ?, ?, ?, ?, ?)", [(n, *r) for n, r in enumerate(rows)])

    def closer(x, y):
        far = "damerau_levenshtein(q, {})".format
        return f"case when {x} is null or ({y} is not null and {far(y)} < {far(x)}) then {y} else {x} end"

    want = con.execute(
        f"select coalesce(nullif({closer('a', 'b')}, ''), {closer('c', 'd')}) from t order by n"
    ).fetchall()
    assert got == [w for (w,) in want]


@pytest.mark.parametrize(
    "value, truth, wanted",
    [
        ("a", "a", "match"),
        (None, None, "match"),
        (None, "a", "missing"),
        ("a", None, "unknown"),
        ("ABC", "abc", "capitalization"),
        ("a-b c", "ABC", "special chars"),
        ("--", "..", "special chars"),
        ("ca", "abc", "typo"),
        ("main stret", "main street", "typo"),
        ("Main St", "Main Street", "synonym"),
        ("St Anna", "Saint Anna", "synonym"),
        ("st main abcdef", "road main abcdef", "unknown"),
        ("north side town", "town", "token subset"),
        ("...", "abcdef", "token subset"),
        ("xyzzyx", "abcdef", "unknown"),
    ],
)
def test_error_class(one, value, truth, wanted):
    assert one(lambda v, t: sim.error_class(v, t), [(value, truth)], "v string, t string") == [wanted]


def test_alias_table_of_any_size(one):
    many = {f"t{i}": [f"word{i}"] for i in range(20_000)}
    rows = [("Foo t19999 xyzabc", "foo word19999 XYZABC"), ("foo t7 abcdefg", "foo word8 abcdefg")]
    got = one(lambda v, t: sim.same_expansion(F.lower(v), F.lower(t), many), rows, "v string, t string")
    assert got == [True, False]


def test_own_aliases(one):
    got = one(lambda v, t: sim.error_class(v, t, {"pza": ["piazza"]}), [("Pza Roma", "Piazza Roma")], "v string, t string")
    assert got == ["synonym"]


def test_aliases_as_a_table(spark):
    """As with the aliases in the plan, on random texts, and with very many aliases."""
    rng = random.Random(11)
    words = ["st", "street", "saint", "ave", "avenue", "mt", "mount", "north", "n", "Oak", "q1"]
    aliases = {"st": ["street", "saint"], "str": ["street"], "ave": ["avenue"], "mt": ["mount", "st"], "n": ["north"]}

    def text():
        return rng.choice([None, "", " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))), "Main St. " * rng.randrange(3)])

    def other(value):
        if value is None or rng.random() < 0.3:
            return text()
        return " ".join(rng.choice([w, *aliases.get(w, []), "saint"]) for w in value.split(" "))

    rows = [(i, *(x for v in (text(), text()) for x in (v, other(v)))) for i in range(1500)]
    pairs = spark.createDataFrame(rows, "row_id long, a string, true_a string, b string, true_b string")
    few = spark.createDataFrame([(t, w) for t, ws in aliases.items() for w in ws + ws[:1]] + [(None, "x")], "token string, word string")
    many = spark.range(100_000).selectExpr("concat('zz', id) as token", "concat('yy', id % 1000) as word")
    want = sorted(map(tuple, errors.cell_errors(pairs, aliases).collect()))
    assert Counter(w[2] for w in want)["synonym"] > 50
    for table in (few, few.unionByName(many)):
        found = errors.cell_errors_by_table(pairs, table)
        assert sorted(map(tuple, found.collect())) == want
    plan = found._jdf.queryExecution().toString()
    assert "from_json" not in plan and "zz1," not in plan
    sums = spark.createDataFrame([(1, "zz7 x", "zz1007 X x"), (2, "zz7 a", "zz1007 a"), (3, "zz70 bcd e", "yy70 Bcd e"), (4, "zz7 a", "zz8 a")], "row_id long, a string, true_a string")
    got = {r["row_id"]: r["errortype"] for r in errors.cell_errors_by_table(sums, many).collect()}
    assert got == {1: "unknown", 2: "synonym", 3: "typo", 4: "typo"}
    assert errors.cell_errors_by_table(pairs.limit(0), few).count() == 0
