"""JSON-LD records to validated triples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from streetloom.operators import geocode, objects
from streetloom.plans import extract
from streetloom.schemas import TRIPLE_SCHEMA, strings
from streetloom.session import scratch_folder
from streetloom.sources import files, manifest, places, runs

TABLES = ["triples", "done"]
TRIPLES = T.StructType(
    TRIPLE_SCHEMA.fields + strings("file_id", "part").fields + strings("run", "segment").fields
)


def validate_triples(
    records: DataFrame,
    places: DataFrame,
    index: DataFrame | None = None,
    stage: str | None = None,
    kept: Sequence[str] = (),
) -> DataFrame:
    """(osm, crawl, address_query) for every object with a postal address, and ``kept`` columns."""
    queries = objects.address_query(objects.address_objects(records))
    looked_up = geocode.geocode(objects.normalised_query(queries), places, index, stage)
    return geocode.assemble_triples(looked_up, kept)


def finished(spark: SparkSession, out: str) -> DataFrame:
    """(file_id, run): archives whose records were looked up, and the run that counts."""
    done = runs.committed(spark, out, "done", "file_id string, run string")
    return runs.owners(spark, out, done, "file_id")


def read_triples(spark: SparkSession, out: str) -> DataFrame:
    """The triples of all finished archives, with file_id, part, run and segment."""
    rows = runs.committed(spark, out, "triples", TRIPLES, "json")
    return rows.join(finished(spark, out), ["file_id", "run"], "left_semi")


def run(
    spark: SparkSession, extracted: str, index: str, out: str, name: str | None = None
) -> str:
    """Look up the addresses of newly extracted archives; returns the run.

    ``extracted`` is the folder of the extract job, ``index`` that of a place index.  Archives
    that an earlier run finished are left out, so nothing is looked up twice; what a run adds
    to ``triples`` (gzip JSON by segment) and ``done`` counts once it is committed.
    """
    name = name or runs.new_name()
    if runs.is_committed(spark, out, name):
        return name
    with scratch_folder(spark, "validate") as stage:
        ready = extract.finished(spark, extracted).select("file_id")
        manifest.pending(ready, finished(spark, out)).write.parquet(f"{stage}/todo")
        todo = spark.read.parquet(f"{stage}/todo")
        if todo.isEmpty():
            return name
        records = extract.read_records(spark, extracted).join(todo, "file_id", "left_semi")
        triples = validate_triples(
            records.drop("run"),
            places.current_places(spark, index),
            places.key_index(spark, index),
            f"{stage}/look-up",
            ["file_id", "part", "segment"],
        )
        files.write_records(triples, runs.folder(out, "triples", name), "overwrite")
        todo.write.mode("overwrite").parquet(runs.folder(out, "done", name))
        runs.commit(spark, out, name)
    return name
