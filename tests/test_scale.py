"""Properties of the physical plans that matter on large data."""

import pytest
from pyspark.sql import functions as F

from checks.catalog import QUERIES
from streetloom.operators import errors, geocode, repair
from tests.conftest import SF_DIR
from tests.test_jobs import PLACE


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    changed = {}

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", QUERIES)
def test_no_products_of_tables(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize(
    "name",
    ["error_matrix", "error_classes", "repair_report", "pack_dataset", "geocode_join", "nested_objects", "query_normalise"],
)
def test_no_python_in_the_hot_path(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Python" not in text and "Arrow" not in text and "InPandas" not in text


def test_only_needed_columns_are_read(spark, tmp_path):
    spark.range(10).selectExpr("id as row_id", "'a' as x", "'b' as y", "'c' as z").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    text = plan(errors.cell_errors(errors.pair_join(t, t, ["x"])))
    assert "ReadSchema: struct<row_id:bigint,x:string>" in text
    assert "y" not in text.split("ReadSchema")[1].split(">")[0]


def test_updates_need_one_aggregate_and_one_join(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    dirty = spark.range(10).selectExpr("id as row_id", "'a' as x")
    updates = spark.range(10).selectExpr("id as ord", "id as row", "0 as col", "'b' as value")
    text = plan(repair.apply_cell_updates(dirty, updates, ["x"]))
    assert text.count("Exchange hashpartitioning") == 2


def test_a_hot_address_is_split(spark, settings, tmp_path):
    """A third of all rows ask for one address; another third share a town."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="20k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="30k",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        shuffle__partitions="16",
    )
    n = 60_000
    third = F.col("id") % 3
    asked = spark.range(0, n, 1, 8).select(
        "id",
        F.when(third == 0, "Hot").otherwise(F.concat(F.lit("Shop "), "id")).alias("name"),
        F.when(third == 0, "Main 1").otherwise(F.concat(F.lit("Road "), F.col("id") % 977, F.lit(" 2"))).alias("street"),
        F.when(third < 2, "Town").otherwise(F.concat(F.lit("City "), F.col("id") % 500)).alias("city"),
        F.lit(None).cast("string").alias("postalcode"),
        F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("string").alias("state"),
    )
    places = spark.createDataFrame(
        [(1, "Hot", "1", "Main", "1", "Town", "E", "Landia", "la"), (2, "x", "9", "y", "2", "City 2", "E", "Landia", "la"),
         (3, None, None, None, None, "Town", "E", "Landia", "la")],
        PLACE,
    )
    stage = str(tmp_path / "stage")
    df = geocode.geocode(asked, places, stage=stage).select("id", "place_id")
    rows = df.collect()
    assert "skew=true" in plan(df)
    assert len(rows) == n
    got = {r["id"]: r["place_id"] for r in rows}
    # the shops of the town that are not listed are answered by the town, not by another shop
    assert all(got[i] == [1, 3, None][i % 3] for i in range(n))
