import hashlib

from pyspark.sql import functions as F

from streetloom.operators import repair, tables
from streetloom.plans import older


def test_row_ids_are_complete_and_repeatable(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("a"), F.when(F.col("id") % 3 > 0, "x").alias("b"))
    first = {(r["a"], r["row_id"]) for r in tables.with_row_id(df).collect()}
    second = {(r["a"], r["row_id"]) for r in tables.with_row_id(df.repartition(7)).collect()}
    assert first == second
    assert sorted(i for _, i in first) == list(range(5000))


def test_exact_sample(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("a"))
    want = sorted((hashlib.md5(f"={i}".encode()).hexdigest(), str(i)) for i in range(3000))[:700]
    got = tables.exact_sample(df.repartition(5), 700).collect()
    assert sorted(r["a"] for r in got) == sorted(a for _, a in want)
    assert tables.exact_sample(df, 9000).count() == 3000


def test_row_index_over_many_ranges(spark):
    df = spark.range(2000).select((F.col("id") * 3 - 1500).alias("o"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
    got = tables.row_index(df, "o", ["g"], width=50).collect()
    groups = {}
    for r in sorted(got, key=lambda r: r["o"]):
        groups.setdefault(r["g"], []).append(r["row_index"])
    assert set(groups) == {None, 1, 2}
    assert all(ix == list(range(len(ix))) for ix in groups.values())


def test_dedupe_keeps_the_first(spark):
    rows = [("a", None, "u2", 2), ("a", None, "u1", 1), ("b", "x", "u3", 3)]
    df = spark.createDataFrame(rows, "k string, n string, url string, ord int")
    got = {tuple(r) for r in tables.dedupe_keep_first(df, ["url"], ["ord"]).collect()}
    assert got == {("a", None, "u1", 1), ("b", "x", "u3", 3)}


def test_distinct_is_idempotent(spark):
    df = spark.createDataFrame([("a", "u"), ("a", "u")], "k string, url string")
    once = tables.dedupe_keep_first(df, [], ["url"])
    assert once.count() == tables.dedupe_keep_first(once, [], ["url"]).count() == 1


def test_observed_count(spark):
    df, seen = tables.observe_count(spark.range(7).toDF("x"), "rows-seen")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7}


def test_clean_counts_of_one_pass(spark):
    kind = "name string, street string, locality string, url string"
    some = [("a", "s 1", "x", "u1"), ("a", "s  1", "x", "u2"), ("a", " - ", "x", "u"), ("b", None, "x", "u"), (None, "s", "y", None)]
    for values in (some, []):
        df = spark.createDataFrame(values, kind)
        counts = older.clean_counts(df)
        got = {r["stage"]: r["rows"] for r in counts.collect()}
        assert got == {"clean:count_before": len(values), "clean:count_after": older.clean_rows(df).count()}
        assert counts._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1


def _repair(spark, rows):
    """rows of (truth, dirty, repaired) for one column"""
    numbered = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(numbered, "row_id long, t string, d string, r string")
    parts = [df.select("row_id", F.col(c).alias("c")) for c in "tdr"]
    return repair.repair_triples(*parts, columns=["c"])


def test_null_rules_differ_by_measure(spark):
    triples = _repair(
        spark,
        [
            (None, "x", None),  # changed; null repaired to null counts as correct; no error for recall
            (None, None, None),  # unchanged; an error before and after for the distance
            ("a", None, "a"),  # changed and right; a missing value is no error for recall
            ("a", "b", "a"),  # changed, right, error
            ("a", "b", "c"),  # changed, wrong, still an error that was touched
            ("a", "b", "b"),  # untouched error
            ("a", "null", None),  # text null equals missing: not changed
        ],
    )
    m = repair.repair_metrics(triples, columns=["c"]).first()
    assert (m["changed"], m["correct"], m["errors"], m["changed_errors"]) == (4, 3, 4, 2)
    assert (m["precision"], m["recall"]) == (0.75, 0.5)
    assert abs(m["f1"] - 0.6) < 1e-12
    d = repair.error_distance(triples, columns=["c"]).first()
    assert (d["errors_before"], d["errors_after"]) == (7, 5)


def test_no_change_gives_null_not_an_error(spark):
    triples = _repair(spark, [("a", "b", "b"), ("a", "a", "a")])
    m = repair.repair_metrics(triples, columns=["c"]).first()
    assert (m["changed"], m["precision"], m["recall"], m["f1"]) == (0, None, 0.0, None)
    assert repair.error_distance(triples, columns=["c"]).first()["edr"] == 0.0


def test_update_to_null_and_last_wins(spark):
    dirty = spark.createDataFrame([(0, "a", "b"), (1, "c", "d")], "row_id long, x string, y string")
    updates = spark.createDataFrame(
        [(0, 0, 0, "n1"), (1, 0, 0, None), (2, 1, 1, "q"), (3, 1, 1, "r")],
        "ord long, row long, col int, value string",
    )
    got = {tuple(r) for r in repair.apply_cell_updates(dirty, updates, ["x", "y"]).collect()}
    assert got == {(0, None, "b"), (1, "c", "r")}
    assert {tuple(r) for r in repair.last_updates(updates).collect()} == {(0, 0, None), (1, 1, "r")}
