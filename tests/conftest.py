import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import duck, session  # noqa: E402
from streetloom import configure  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = configure(session(partitions="4"))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def con():
    return duck(SF_DIR)


@pytest.fixture
def one(spark):
    """Apply a column function to a list of rows and return the results in order."""

    def run(function, rows, schema):
        columns = [part.split()[0] for part in schema.split(",")]
        numbered = [(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)]
        df = spark.createDataFrame(numbered, f"n int, {schema}").repartition(2)
        out = df.select("n", function(*[df[c] for c in columns]).alias("out"))
        return [r["out"] for r in sorted(out.collect(), key=lambda r: r["n"])]

    return run
