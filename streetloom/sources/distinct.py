"""A table of distinct rows that grows run by run.

Rows are known by a hash of their content, by which the table is bucketed.  A run makes its
own rows distinct and adds those that no committed run has: only the new rows are shuffled,
the table is joined as it lies.

Defined results: null and empty text differ; a column that the new rows lack fails the run;
extra columns are ignored; should two runs add the same row at the same time, it is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.operators.tables import content_hash
from streetloom.session import scratch_folder
from streetloom.sources import buckets

NAME, KEY = "rows", "row_hash"


def _ddl(columns: list[str]) -> str:
    return f"{KEY} STRING, " + ", ".join(f"`{c}` STRING" for c in columns)


def create(spark: SparkSession, folder: str, files: int = buckets.BUCKETS) -> None:
    """An empty table in a folder not yet in use, of ``files`` buckets until it needs more."""
    buckets.lay_out(spark, folder, files)


def add(spark: SparkSession, folder: str, rows: DataFrame, columns: list[str]) -> int:
    """Add the rows (text ``columns``) that the table does not have; returns the generation."""
    ddl = _ddl(columns)
    with scratch_folder(spark, "distinct") as stage:
        keyed = rows.select(content_hash(columns).alias(KEY), *columns).distinct()
        known = buckets.committed(spark, folder, NAME, ddl, KEY).select(KEY)
        keyed.join(known, KEY, "left_anti").write.parquet(f"{stage}/new")
        new = spark.read.parquet(f"{stage}/new")
        gen = buckets.next_generation(spark, folder)
        layout = buckets.room(spark, folder, [(NAME, ddl, KEY)], new.count())
        buckets.append(spark, folder, layout, NAME, ddl, KEY, new, gen)
        buckets.commit(spark, folder, layout, gen)
    return gen


def read(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """All rows, each once."""
    rows = buckets.committed(spark, folder, NAME, _ddl(columns), KEY)
    once = rows.groupBy(KEY).agg(F.min_by(F.struct(*columns), "gen").alias("row"))
    return once.select("row.*")
