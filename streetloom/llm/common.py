"""Helpers shared by the training-data operators.

Column names that start with two underscores belong to the operators while they run.  Input
columns are renamed away from them where a whole row is carried along, so a clash is harmless.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.session import drop_path, scratch_path

#: White space between words: space and the five control characters from tab to return.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"


_COLLECTORS: list[list] = []


@contextmanager
def collected(paths: list):
    """Collect the folders of stage tables that results handed out meanwhile still read."""
    _COLLECTORS.append(paths)
    try:
        yield paths
    finally:
        _COLLECTORS.remove(paths)


def staged(spark: SparkSession, df: DataFrame, label: str, paths: list | None = None) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    The plan is cut, a lost executor costs nothing that was written, and values that depend
    on the run (row numbers) are fixed.  ``paths`` collects the folder for `release`.
    """
    path = scratch_path(spark, label)
    df.write.parquet(path)
    if paths is None and _COLLECTORS:
        paths = _COLLECTORS[-1]
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, paths: list) -> None:
    """Remove stage tables that no plan reads any more."""
    while paths:
        drop_path(spark, paths.pop())


def words(text: Column) -> Column:
    """The words of a text (null: none) as an array of strings."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also when used inside a lambda."""
    return F.transform(F.array(value), body)[0]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def qualified(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rename all columns to ``__in0``, ``__in1`` … and return the old names in order.

    An operator that carries whole rows can then add columns of any name.
    """
    return df.toDF(*[f"__in{i}" for i in range(len(df.columns))]), df.columns


def restored(df: DataFrame, names: list[str], *more: Column) -> DataFrame:
    """Undo `qualified`; ``more`` columns follow."""
    return df.select(*[F.col(f"__in{i}").alias(n) for i, n in enumerate(names)], *more)


def column_of(names: list[str], name: str) -> str:
    """The renamed column that `qualified` made of ``name``."""
    return f"__in{names.index(name)}"
