import json
import random

import pytest
from pyspark.errors import PySparkException

from streetloom.sources import files


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def read(spark, path):
    return [json.loads(r["element"]) for r in files.read_json_list(spark, str(path)).orderBy("file", "ord").collect()]


def element(rng):
    def text():
        return "".join(rng.choice(['"', "\\", "}", "{", "]", "[", ",", "é", " ", "\n", "a", "}}", '\\"}']) for _ in range(rng.randrange(12)))

    kind = rng.randrange(5)
    if kind == 0:
        return {}
    if kind == 1:
        return {text(): {"a": [{}, {"b": text()}, [[]]], "c": {"}": None}}}
    return {"row": rng.randrange(99), "col": rng.randrange(5), "value": rng.choice([None, text(), "x" * 900 + text()])}


@pytest.mark.parametrize("indent", [None, 1])
def test_lists_are_read_in_splits(spark, tmp_path, small_splits, indent):
    rng = random.Random(3)
    rows = [element(rng) for _ in range(400)]
    path = tmp_path / "list.json"
    path.write_text(json.dumps(rows, indent=indent, ensure_ascii=bool(indent)))
    assert read(spark, path) == rows
    found = files.read_json_list(spark, str(path))
    assert sorted(r["ord"] for r in found.collect()) == list(range(400))
    pieces = spark.read.option("lineSep", "}").text(str(path))
    assert pieces.rdd.getNumPartitions() > 20


def test_several_files_blank_ends_and_empty_lists(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text(" \n[ ]\n")
    (tmp_path / "b.json").write_text('\n[ {"row":1}\n,\n{"row":2} ]\n\n')
    (tmp_path / "c.json").write_text("[]")
    assert read(spark, tmp_path) == [{"row": 1}, {"row": 2}]


@pytest.mark.parametrize("text", ['[{"a":1}', '[{"a":1},{"b":', '{"a":1}', '[{"a":1},2]', '[1]', "[null,{}]", '[{"a":"}]'])
def test_what_is_no_list_of_objects_fails(spark, tmp_path, text):
    path = tmp_path / "odd.json"
    path.write_text(text)
    with pytest.raises(PySparkException):
        read(spark, path)


def test_many_updates(spark, tmp_path):
    path, n = tmp_path / "cells.json", 300_000
    with path.open("w") as out:
        out.write("[")
        for i in range(n):
            out.write(("," if i else "") + json.dumps({"row": i // 3, "col": i % 8, "value": f'v{i} "}}" {{'}))
        out.write("]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    try:
        got = files.read_cell_updates(spark, str(path))
        assert got.selectExpr("count(*)", "count(distinct ord)", "max(ord)", "sum(row)", "count_if(value = concat('v', ord, ' \"}\" {'))").first() == (
            n, n, n - 1, sum(i // 3 for i in range(n)), n
        )
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
