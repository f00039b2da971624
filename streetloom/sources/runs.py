"""Tables that jobs fill run by run, and that readers see run by run.

A run writes its rows of each table to a folder of its own, ``<out>/<table>/run=<name>``, and
at its end one row to ``<out>/commits``.  That row is one file, put in place by one rename or
one put, so a run counts as a whole or not at all, wherever it stops.  Readers join tables
with the commits.  A run that starts again under its name replaces what it wrote; one that is
committed has nothing left to do.  Should two runs take the same input at the same time, the
rows of the first to be committed count (`owners`).

Folders of runs that never ended are removed by `sweep`; readers do not see them.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.session import drop_path, exists, folders

COMMITS = "run string, at long"


def new_name() -> str:
    return f"run-{uuid.uuid4().hex}"


def folder(out: str, table: str, run: str) -> str:
    """Where a run writes its rows of a table."""
    return f"{out.rstrip('/')}/{table}/run={run}"


def commits(spark: SparkSession, out: str) -> DataFrame:
    """(run, at): the runs that count, and when they were committed."""
    path = f"{out.rstrip('/')}/commits"
    if not exists(spark, path):
        return spark.createDataFrame([], COMMITS)
    return spark.read.schema(COMMITS).parquet(path)


def is_committed(spark: SparkSession, out: str, run: str) -> bool:
    return not commits(spark, out).where(F.col("run") == run).isEmpty()


def commit(spark: SparkSession, out: str, run: str) -> None:
    """Let a run count: one row in one file."""
    row = spark.createDataFrame([(run, time.time_ns())], COMMITS).coalesce(1)
    row.write.mode("append").parquet(f"{out.rstrip('/')}/commits")


def committed(spark: SparkSession, out: str, table: str, schema, form: str = "parquet") -> DataFrame:
    """The rows of a table that committed runs wrote; ``schema`` includes ``run``."""
    path = f"{out.rstrip('/')}/{table}"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.format(form).schema(schema).option("mode", "FAILFAST").load(path)
    return rows.join(commits(spark, out).select("run").distinct(), "run", "left_semi")


def owners(spark: SparkSession, out: str, inputs: DataFrame, key: str) -> DataFrame:
    """(key, run): for each finished input the run committed first; ``inputs`` has key and run."""
    timed = inputs.join(commits(spark, out), "run")
    return timed.groupBy(key).agg(F.min_by("run", F.struct("at", "run")).alias("run"))


def sweep(spark: SparkSession, out: str, tables: list[str], running: list[str] = ()) -> list[str]:
    """Remove what runs left that are neither committed nor ``running``; returns their names."""
    ended = {r["run"] for r in commits(spark, out).collect()} | set(running)
    gone = set()
    for table in tables:
        for name in folders(spark, f"{out.rstrip('/')}/{table}"):
            run = name.removeprefix("run=")
            if run != name and run not in ended:
                drop_path(spark, folder(out, table, run))
                gone.add(run)
    return sorted(gone)
