import random

import pytest
from pyspark.sql import functions as F

from streetloom.operators.tables import content_hash
from streetloom.session import read_by
from streetloom.sources import buckets, distinct, runs
from tests.test_archive import Crash

COLUMNS = ["a", "b"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "a string, b string").withColumn("row_hash", F.lit("x"))


def test_runs_add_what_is_new(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    folder, seen = str(tmp_path / "table"), set()
    distinct.create(spark, folder, 3)
    assert distinct.read(spark, folder, COLUMNS).count() == 0

    def rows():
        return [(rng.choice(["x", "", None, "y z"]), rng.choice([None, "", "1", "2", str(rng.randrange(40))])) for _ in range(60)]

    def check():
        got = list(map(tuple, distinct.read(spark, folder, COLUMNS).collect()))
        assert len(got) == len(seen) and set(got) == seen

    for _ in range(3):
        new = rows()
        distinct.add(spark, folder, frame(spark, new * 2), COLUMNS)
        seen |= set(new)
        check()
    files = spark.read.parquet(f"{folder}/rows")
    assert files.count() == len(seen)
    assert files.groupBy("gen").count().count() == 3
    distinct.add(spark, folder, frame(spark, new), COLUMNS)  # nothing new
    assert spark.read.parquet(f"{folder}/rows").count() == len(seen)

    def lost(*args):
        raise Crash

    later = rows()
    monkeypatch.setattr(runs, "commit", lost)
    with pytest.raises(Crash):
        distinct.add(spark, folder, frame(spark, later), COLUMNS)
    check()
    monkeypatch.undo()
    distinct.add(spark, folder, frame(spark, later), COLUMNS)
    seen |= set(later)
    check()
    # a run that did not see another one's commit
    known = buckets.committed
    monkeypatch.setattr(buckets, "committed", lambda *args: known(*args).limit(0))
    distinct.add(spark, folder, frame(spark, later), COLUMNS)
    monkeypatch.undo()
    check()


def test_buckets_grow_while_another_run_adds(spark, tmp_path, monkeypatch):
    """Rows that a run adds to the layout it began with count beside those of a wider one, each once."""
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 50, raising=False)
    folder, ddl = str(tmp_path / "table"), distinct._ddl(COLUMNS)
    table = (distinct.NAME, ddl, distinct.KEY)
    distinct.create(spark, folder, 2)
    first = [(str(i), None) for i in range(40)]
    distinct.add(spark, folder, frame(spark, first), COLUMNS)
    late = frame(spark, [("late", ""), ("0", None)]).select(content_hash(COLUMNS).alias("row_hash"), *COLUMNS)
    layout, gen = buckets.room(spark, folder, [table], 2), buckets.next_generation(spark, folder)
    buckets.append(spark, folder, layout, *table, late, gen)
    many = [(str(i), "x") for i in range(500)]
    distinct.add(spark, folder, frame(spark, many), COLUMNS)
    buckets.commit(spark, folder, layout, gen)
    seen = {*first, *many, ("late", "")}
    got = list(map(tuple, distinct.read(spark, folder, COLUMNS).collect()))
    assert len(got) == len(seen) and set(got) == seen
    rows = buckets.committed(spark, folder, *table)
    assert rows.count() == len(seen) + 1 and rows.groupBy("gen").count().count() == 3
    files = rows.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert files <= 75
    more = [(str(i), "y") for i in range(1000)]  # wide again: all three are copied
    distinct.add(spark, folder, frame(spark, more + many), COLUMNS)
    got = list(map(tuple, distinct.read(spark, folder, COLUMNS).collect()))
    assert len(got) == len(seen) + 1000 and set(got) == seen | set(more)


def test_many_tasks_read_what_goes_to_many_buckets(spark, tmp_path):
    """Reading tasks grow in number with the buckets, and the session's setting is put back."""
    key = "spark.sql.files.minPartitionNum"
    path = str(tmp_path / "rows")
    spark.range(1000).repartition(40).write.parquet(path)
    assert spark.conf.get(key, None) is None
    with read_by(spark, 30):
        assert spark.read.parquet(path).rdd.getNumPartitions() >= 20
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "3")
    try:
        with pytest.raises(Crash), read_by(spark, 1):
            assert int(spark.conf.get(key)) == spark.sparkContext.defaultParallelism
            raise Crash
        assert spark.conf.get(key) == "3"
    finally:
        spark.conf.unset(key)


def test_the_table_is_not_shuffled(spark, tmp_path):
    folder = str(tmp_path / "table")
    distinct.create(spark, folder, 4)
    distinct.add(spark, folder, frame(spark, [(str(i), None) for i in range(500)]), COLUMNS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = buckets.committed(spark, folder, distinct.NAME, distinct._ddl(COLUMNS), distinct.KEY)
        new = frame(spark, [("1", None), ("x", "y")]).select(content_hash(COLUMNS).alias("row_hash"), *COLUMNS)
        plan = new.join(known.select("row_hash"), "row_hash", "left_anti")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan
        plan = distinct.read(spark, folder, COLUMNS)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_rows(spark, tmp_path):
    folder = str(tmp_path / "table")
    distinct.create(spark, folder, 2)
    distinct.add(spark, folder, frame(spark, []), COLUMNS)
    assert distinct.read(spark, folder, COLUMNS).collect() == []
    with pytest.raises(ValueError):
        distinct.create(spark, folder)
