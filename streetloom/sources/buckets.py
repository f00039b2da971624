"""Bucketed tables that grow by committed generations.

A table is a folder of files bucketed by one key, so joins and groups by that key read it
without a shuffle; the session only knows its layout, which is kept beside it.  Each append
writes one generation of rows, numbered in the column ``gen``, which counts once its commit is
written (`streetloom.sources.runs`).

A bucket is read by one task, so the number of buckets follows the number of rows: before a run
appends, `room` counts them, and if the buckets would get too full, it copies the rows that
count to a layout of more buckets.  That layout names the generations it has; the commit of a
generation names the layout it was written to.  So one that another run adds meanwhile is read
where it lies, and each is read once.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.session import exists, read_by
from streetloom.sources import runs

#: Files that a generation of a small table is shared out over; a multiple of the cores of the cluster is best.
BUCKETS = 64
#: Rows that a bucket may hold; beyond that the table gets three times the buckets it needs.
BUCKET_ROWS = 1 << 19


class Layout(NamedTuple):
    buckets: int
    part: str = ""  # names the folders of its tables; the first layout has none
    copied: tuple[int, ...] = ()


def _publish(spark: SparkSession, folder: str, layout: Layout) -> None:
    """Let a layout count: one row in one file."""
    row = spark.createDataFrame([layout], "buckets int, part string, copied array<long>")
    row.coalesce(1).write.mode("append").json(f"{folder}/layout")


def lay_out(spark: SparkSession, folder: str, buckets: int = BUCKETS) -> None:
    """Begin a folder of bucketed tables."""
    if exists(spark, f"{folder}/layout"):
        raise ValueError(f"there are tables in {folder}")
    _publish(spark, folder, Layout(buckets))


def _layouts(spark: SparkSession, folder: str) -> list[Layout]:
    """All layouts, the one in use last."""
    rows = spark.read.schema("buckets int, part string, copied array<long>").json(f"{folder}/layout").collect()
    return sorted(Layout(r["buckets"], r["part"] or "", tuple(r["copied"] or ())) for r in rows)


def _table(spark: SparkSession, folder: str, layout: Layout, name: str, columns: str, key: str) -> str:
    """The table of this session over ``<folder>/<name>``, or that of a later layout."""
    part = layout.part and f"-{layout.part}"
    table = f"t_{name}_{hashlib.md5(f'{folder}{part}'.encode()).hexdigest()}"
    if not spark.catalog.tableExists(table):
        where = f"{folder}/{name}{part}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {table} ({columns}, gen BIGINT) USING parquet CLUSTERED BY ({key}) "
            f"SORTED BY ({key}) INTO {layout.buckets} BUCKETS LOCATION '{where}'"
        )
    return table


def _written(spark: SparkSession, folder: str) -> dict[int, str]:
    """The appends that count, and the layout each was written to."""
    named = (r["run"].partition("-") for r in runs.commits(spark, folder).collect())
    return {int(gen): part for gen, _, part in named}


def generations(spark: SparkSession, folder: str) -> list[int]:
    """The appends that count: one number each."""
    return sorted(_written(spark, folder))


def next_generation(spark: SparkSession, folder: str) -> int:
    return max([time.time_ns(), *[g + 1 for g in generations(spark, folder)]])


def committed(spark: SparkSession, folder: str, name: str, columns: str, key: str) -> DataFrame:
    """The rows that count, with their generation."""
    written = _written(spark, folder)  # before the layouts, so that each of theirs is known
    layouts = {layout.part: layout for layout in _layouts(spark, folder)}
    *_, now = layouts.values()
    found: dict[str, list[int]] = {now.part: []}
    for gen, part in sorted(written.items()):
        found.setdefault(now.part if gen in now.copied else part, []).append(gen)
    frames = []
    for part, gens in found.items():
        table = _table(spark, folder, layouts[part], name, columns, key)
        spark.catalog.refreshTable(table)  # other sessions may have added files
        if gens or not any(found.values()):
            frames.append(spark.table(table).where(F.col("gen").isin(gens)))
    return reduce(DataFrame.unionByName, frames)


def _write(
    spark: SparkSession, folder: str, layout: Layout, name: str, columns: str, key: str, rows: DataFrame
) -> None:
    table = _table(spark, folder, layout, name, columns, key)
    rows = rows.repartition(layout.buckets, key)
    # a task holds what it deals out to many buckets, so the tasks that read the rows grow in number too
    with read_by(spark, layout.buckets // 4):
        rows.select(*spark.table(table).columns).write.insertInto(table)


def room(spark: SparkSession, folder: str, tables: list[tuple[str, str, str]], rows: int) -> Layout:
    """The layout to append to, where each of the ``tables`` can take so many ``rows`` more."""
    now = _layouts(spark, folder)[-1]
    held = max(committed(spark, folder, *table).count() for table in tables)
    needed = -(-(held + rows) // BUCKET_ROWS)
    if needed <= now.buckets:
        return now
    wide = Layout(3 * needed, uuid.uuid4().hex, tuple(generations(spark, folder)))
    if wide.copied:
        for table in tables:
            _write(spark, folder, wide, *table, committed(spark, folder, *table))
    _publish(spark, folder, wide)
    return wide


def append(
    spark: SparkSession, folder: str, layout: Layout, name: str, columns: str, key: str, rows: DataFrame, gen: int
) -> None:
    """Write rows of a generation to a layout (from `room`); `commit` makes them count."""
    _write(spark, folder, layout, name, columns, key, rows.withColumn("gen", F.lit(gen).cast("long")))


def commit(spark: SparkSession, folder: str, layout: Layout, gen: int) -> None:
    """Let a generation count that was appended to a layout."""
    runs.commit(spark, folder, f"{gen}-{layout.part}" if layout.part else str(gen))
