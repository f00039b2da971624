import random
import re

import pytest
from pyspark.sql import functions as F

from streetloom.operators import geocode
from streetloom.plans import extract, validate
from streetloom.sources import buckets, places, runs
from tests.test_archive import Crash, four_archives, listed, place, segment
from tests.test_jobs import PLACE


def some_places(rng, ids):
    def word(options):
        return rng.choice([*options, None])

    return [
        (i, word(["Cafe", "Bar"]), word(["1", "2"]), word(["Main", "Oak"]), word(["100", "200"]),
         word(["Town", "City"]), word(["East", "West"]), *rng.choice([("Landia", "la"), ("Other", "ot"), (None, None)]))
        for i in ids
    ]


def answers(index):
    rows = index.collect()
    found = {r["key"]: r["place_id"] for r in rows}
    assert len(found) == len(rows)
    return found


def check(spark, folder, now):
    """The index holds these places, and answers as one made from them."""
    table = spark.createDataFrame(now, PLACE)
    assert sorted(map(tuple, places.current_places(spark, folder).collect())) == sorted(now)
    assert answers(places.key_index(spark, folder)) == answers(geocode.place_index(table))


@pytest.mark.parametrize("seed", range(3))
def test_merges_equal_a_new_index(spark, tmp_path, seed):
    rng = random.Random(seed)
    folder = str(tmp_path / "it's an index")
    now = some_places(rng, range(40))
    places.create(spark, folder, spark.createDataFrame(now, PLACE), 3)
    check(spark, folder, now)
    for _ in range(3):
        known = {p[0]: p for p in now}
        changed = some_places(rng, rng.sample(range(80), 12))
        gone = rng.sample(range(90), 12)  # some are unknown, some changed at the same time
        for key in gone:
            known.pop(key, None)
        known |= {p[0]: p for p in changed}
        now = list(known.values())
        removed = spark.createDataFrame([(k,) for k in gone * 2], "place_id long")
        places.merge(spark, folder, spark.createDataFrame(changed, PLACE), removed)
        check(spark, folder, now)
    now = some_places(rng, range(20, 60))
    places.update(spark, folder, spark.createDataFrame(now, PLACE))
    check(spark, folder, now)
    places.rewrite(spark, folder, str(tmp_path / "new"), 2)
    check(spark, str(tmp_path / "new"), now)
    places.update(spark, folder, spark.createDataFrame([], PLACE))
    check(spark, folder, [])


def test_only_changes_are_merged(spark, tmp_path):
    rng = random.Random(5)
    folder, now = str(tmp_path / "index"), some_places(rng, range(50))
    places.create(spark, folder, spark.createDataFrame(now, PLACE), 2)
    keys = spark.read.parquet(f"{folder}/keys").count()
    gen = places.update(spark, folder, spark.createDataFrame(now, PLACE))
    assert spark.read.parquet(f"{folder}/keys").count() == keys
    other = [(*now[0][:1], "Kiosk", *now[0][2:]), *now[1:]]
    changed, gone = places.changes(spark, folder, spark.createDataFrame(other, PLACE))
    assert [r["place_id"] for r in changed.collect()] == [now[0][0]] and gone.isEmpty()
    assert places.update(spark, folder, spark.createDataFrame(other, PLACE)) > gen
    check(spark, folder, other)
    assert spark.read.parquet(f"{folder}/places").count() == len(now) + 1
    with pytest.raises(ValueError):
        places.create(spark, folder, spark.createDataFrame(now, PLACE))


def test_a_merge_that_stops_is_not_seen(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    folder, now = str(tmp_path / "index"), some_places(rng, range(20))
    places.create(spark, folder, spark.createDataFrame(now, PLACE), 2)
    later = some_places(rng, range(10, 30))

    def lost(*args):
        raise Crash

    monkeypatch.setattr(runs, "commit", lost)
    with pytest.raises(Crash):
        places.merge(spark, folder, spark.createDataFrame(later, PLACE))
    check(spark, folder, now)
    monkeypatch.undo()
    places.merge(spark, folder, spark.createDataFrame(later, PLACE))
    check(spark, folder, list(({p[0]: p for p in now} | {p[0]: p for p in later}).values()))


def test_buckets_grow_with_the_index(spark, tmp_path, monkeypatch):
    """However many places come at once or later, no task reads many more rows than a bucket may hold."""
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 200, raising=False)
    rng = random.Random(8)
    folder = str(tmp_path / "index")

    def fullest(table):
        rows = buckets.committed(spark, folder, *table).withColumn("file", F.input_file_name())
        bucket = F.regexp_extract("file", r"_(\d+)\.c000", 1)
        return rows.groupBy(bucket).count().agg(F.max("count")).first()[0] or 0

    now = some_places(rng, range(10))
    places.create(spark, folder, spark.createDataFrame(now, PLACE), 2)
    check(spark, folder, now)
    assert fullest(places.KEYS) <= 300
    for ids in (range(10, 60), range(60, 900), range(850, 950)):
        changed = some_places(rng, ids)
        now = list(({p[0]: p for p in now} | {p[0]: p for p in changed}).values())
        places.merge(spark, folder, spark.createDataFrame(changed, PLACE), spark.createDataFrame([(ids[0] - 1,)], "place_id long"))
        now = [p for p in now if p[0] != ids[0] - 1]
        check(spark, folder, now)
        assert fullest(places.KEYS) <= 300 and fullest(places.PLACES) <= 300
    assert any(layout.copied for layout in buckets._layouts(spark, folder))
    places.update(spark, folder, spark.createDataFrame(now[:50], PLACE))
    check(spark, folder, now[:50])


def test_keys_are_combined_in_small_tasks(spark):
    """A task combines the keys of a bounded number of places, however few splits they come in."""
    table = spark.range(geocode.TASK_PLACES * 3 // 2).coalesce(1).selectExpr(
        "id as place_id", "concat('Shop ', id) as name", *[f"cast(null as string) as {f}" for f in places.FIELDS[1:3]],
        "'100' as postcode", *[f"cast(null as string) as {f}" for f in places.FIELDS[4:]],
    )
    index = geocode.place_index(table)
    assert "RoundRobinPartitioning(2)" in index._jdf.queryExecution().executedPlan().toString()
    assert index.count() == geocode.TASK_PLACES * 3 // 2


def test_look_ups_shuffle_no_index(spark, tmp_path):
    """The bucketed tables are read, grouped and joined as they lie."""
    folder = str(tmp_path / "index")
    rng = random.Random(7)
    places.create(spark, folder, spark.createDataFrame(some_places(rng, range(200)), PLACE), 4)
    places.merge(spark, folder, spark.createDataFrame(some_places(rng, range(300, 310)), PLACE))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for table, key in ((places.key_index(spark, folder), "key"), (places.current_places(spark, folder), "place_id")):
            asked = spark.range(1000).select(F.col("id").cast(table.schema[key].dataType).alias(key))
            joined = asked.join(table, key)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, plan
            assert "Bucketed: true" in joined._jdf.queryExecution().explainString(
                spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
            )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_validation_looks_nothing_up_twice(spark, tmp_path, monkeypatch):
    good = four_archives(tmp_path)
    out, index, triples = (str(tmp_path / n) for n in ("out", "index", "triples"))
    table = [(7, None, "5", "Main St", None, "Town", None, None, None), (8, "Café", None, None, None, None, None, None, None)]
    places.create(spark, index, spark.createDataFrame(table, PLACE), 2)
    extract.run(spark, listed(spark, *map(segment, (1, 2, 3))), out, str(tmp_path), 2)
    asked = []
    look_up = geocode.geocode

    def counted(queries, *args):
        asked.append(queries.count())
        return look_up(queries, *args)

    monkeypatch.setattr(validate.geocode, "geocode", counted)
    validate.run(spark, out, index, triples, "first")
    assert validate.read_triples(spark, triples).count() == 3
    validate.run(spark, out, index, triples)  # nothing new: no look-up
    validate.run(spark, out, index, triples, "first")
    assert asked == [3]
    place(tmp_path, 2, good)
    extract.run(spark, listed(spark, segment(2), segment(4)), out, str(tmp_path), 2)

    def lost(*args):
        raise Crash

    commit = runs.commit
    monkeypatch.setattr(runs, "commit", lost)
    with pytest.raises(Crash):
        validate.run(spark, out, index, triples, "second")
    assert validate.read_triples(spark, triples).count() == 3
    monkeypatch.setattr(runs, "commit", commit)
    validate.run(spark, out, index, triples, "second")
    assert asked == [3, 4, 4]
    rows = validate.read_triples(spark, triples).select("file_id", "segment", "crawl.crawl_metadata.url").collect()
    assert sorted(r["file_id"] for r in rows) == sorted([segment(1)] * 3 + [segment(2)] * 3 + [segment(4)])
    assert {r["segment"] for r in rows} == {"1700.1", "1700.2", "1700.4"}


def test_validation_looks_up_in_an_index_that_grew(spark, tmp_path, monkeypatch):
    """A run after a merge of many places reads more buckets, not fuller ones."""
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 100, raising=False)
    good = four_archives(tmp_path)
    out, index, triples = (str(tmp_path / n) for n in ("out", "index", "triples"))
    table = [(7, None, "5", "Main St", None, "Town", None, None, None), (8, "Café", None, None, None, None, None, None, None)]
    places.create(spark, index, spark.createDataFrame(table, PLACE), 2)
    extract.run(spark, listed(spark, *map(segment, (1, 2, 3))), out, str(tmp_path), 2)
    validate.run(spark, out, index, triples)
    many = some_places(random.Random(9), range(100, 600))
    places.merge(spark, index, spark.createDataFrame(many, PLACE))
    read = []
    look_up = geocode.geocode

    def watched(queries, table, keys, *args):
        read.append(keys.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0])
        return look_up(queries, table, keys, *args)

    monkeypatch.setattr(validate.geocode, "geocode", watched)
    place(tmp_path, 2, good)
    extract.run(spark, listed(spark, segment(2), segment(4)), out, str(tmp_path), 2)
    validate.run(spark, out, index, triples)
    assert len(read) == 1 and read[0] <= 150
    rows = validate.read_triples(spark, triples).select("file_id", F.col("osm.properties.geocoding.street").alias("street"))
    assert sorted(r["file_id"] for r in rows.collect()) == sorted([segment(1)] * 3 + [segment(2)] * 3 + [segment(4)])
