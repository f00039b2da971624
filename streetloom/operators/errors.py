"""Error classes of dirty against true values, and their counts.

Two tables are paired by ``row_id``.  Wide tables hold one column per address field; the
counts work on the long form, one row per cell, so each rule is compiled once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.functions.similarity import ALIASES, ERROR_CLASSES, error_class
from streetloom.functions.text import token_sequence
from streetloom.operators.tables import bind
from streetloom.schemas import DATASET_COLUMNS
from streetloom.session import scratch_path


def pair_join(
    dirty: DataFrame, truth: DataFrame, columns: Sequence[str] = tuple(DATASET_COLUMNS)
) -> DataFrame:
    """Dirty values beside true ones (``true_…``), matched on ``row_id``."""
    renamed = truth.select("row_id", *[F.col(c).alias(f"true_{c}") for c in columns])
    return dirty.select("row_id", *columns).join(renamed, "row_id")


def _columns(pairs: DataFrame) -> list[str]:
    return [c[5:] for c in pairs.columns if c.startswith("true_")]


def error_classes(pairs: DataFrame, aliases: Mapping[str, Sequence[str]] = ALIASES) -> DataFrame:
    """One error class per cell, in the wide form.

    The rules run over an array of the cells, so that they are compiled once and not once per
    column.
    """
    columns = _columns(pairs)
    row = F.array(
        *[F.struct(F.col(c).alias("value"), F.col(f"true_{c}").alias("truth")) for c in columns]
    )
    classes = F.transform(row, lambda cell: error_class(cell["value"], cell["truth"], aliases))
    judged = bind(pairs.select("row_id", classes.alias("_c")), {"_c": F.col("_c")})
    return judged.select("row_id", *[F.col("_c")[i].alias(c) for i, c in enumerate(columns)])


def cells(pairs: DataFrame) -> DataFrame:
    """One row per cell: row_id, column_name, value, truth."""
    structs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).alias("value"),
            F.col(f"true_{c}").alias("truth"),
        )
        for c in _columns(pairs)
    ]
    return pairs.select("row_id", F.inline(F.array(*structs)))


def cell_errors(pairs: DataFrame, aliases: Mapping[str, Sequence[str]] = ALIASES) -> DataFrame:
    """One row per cell with its error class."""
    return cells(pairs).select(
        "row_id", "column_name", error_class(F.col("value"), F.col("truth"), aliases).alias("errortype")
    )


def cell_errors_by_table(
    pairs: DataFrame, aliases: DataFrame, stage: str | None = None
) -> DataFrame:
    """`cell_errors` with the aliases as a table of any size: token and word, in lower case.

    Two texts of equally many words can be written out alike if the words at each place where
    they differ can: both stand for a word in common, or one for the other.  The different
    pairs of such words are looked up once each, and a cell counts the places that meet.  The
    classes of the other rules are kept in a table below ``stage`` meanwhile.
    """
    spark = pairs.sparkSession
    stage = stage or scratch_path(spark, "cells")
    truth = F.col("truth")
    a, b = (token_sequence(F.lower(c)) for c in (F.col("value"), truth))
    judged = bind(cells(pairs), {"errortype": error_class(F.col("value"), truth, {})})
    open_ = F.col("errortype").isin("token subset", "unknown") & (F.size(a) == F.size(b))
    places = F.filter(F.arrays_zip(a.alias("x"), b.alias("y")), lambda p: p["x"] != p["y"])
    judged.select("row_id", "column_name", "errortype", F.when(open_, places).alias("places")).write.parquet(stage)
    judged = spark.read.parquet(stage)

    cell = ["row_id", "column_name"]
    open_ = judged.where(F.size("places") > 0).select(*cell, F.size("places").alias("n"), F.inline("places"))
    asked = open_.select("x", "y").distinct()
    forms = aliases.select("token", "word").where("token is not null and word is not null").distinct()
    known = asked.join(forms.withColumnRenamed("token", "x"), "x")
    known = known.unionByName(asked.withColumn("word", F.col("x")))
    both = known.join(forms.withColumnRenamed("token", "y"), ["y", "word"], "left_semi")
    met = known.where(F.col("word") == F.col("y")).unionByName(both.select(*known.columns))
    met = met.select("x", "y").distinct()
    alike = open_.join(met, ["x", "y"]).groupBy(*cell).agg(
        F.count(F.lit(1)).alias("places"), F.first("n").alias("n")
    )
    alike = alike.where(F.col("places") == F.col("n")).select(*cell, F.lit("synonym").alias("synonym"))
    return judged.join(alike, cell, "left").select(
        *cell, F.coalesce("synonym", "errortype").alias("errortype")
    )


def error_counts(cell_classes: DataFrame) -> DataFrame:
    """Cells by column and error class."""
    return cell_classes.groupBy("column_name", "errortype").agg(F.count(F.lit(1)).alias("len"))


def error_matrix(
    cell_classes: DataFrame, order: Sequence[str] = tuple(DATASET_COLUMNS)
) -> DataFrame:
    """Rows are columns of the data set, columns are error classes with counts and shares.

    All classes appear, sorted by name; the rows follow ``order``, unknown columns first.
    """
    classes = sorted(ERROR_CLASSES)
    counted = cell_classes.groupBy("column_name").agg(
        *[F.count_if(F.col("errortype") == c).alias(c) for c in classes],
        F.count(F.lit(1)).alias("rows"),
    )
    shares = [(F.col(f"`{c}`") / F.col("rows")).alias(f"{c} share") for c in classes]
    place = F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col("column_name")), F.lit(0))
    return counted.orderBy(place.asc_nulls_first(), "column_name").select(
        "column_name", *[F.col(f"`{c}`") for c in classes], *shares
    )


def error_type_totals(cell_classes: DataFrame) -> DataFrame:
    """Cells and share of all cells per error class, absent classes included."""
    totals = cell_classes.agg(
        *[F.count_if(F.col("errortype") == c).alias(c) for c in ERROR_CLASSES],
        F.count(F.lit(1)).alias("cells"),
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("errortype"),
                F.col(f"`{c}`").alias("total"),
                F.try_divide(F.col(f"`{c}`"), F.col("cells")).alias("share"),
            )
            for c in ERROR_CLASSES
        ]
    )
    return totals.select(F.inline(rows))


def field_match_counts(cell_classes: DataFrame) -> DataFrame:
    """Matches and mismatches per column with their shares of the rows."""
    counted = cell_classes.groupBy("column_name").agg(
        F.count_if(F.col("errortype") == "match").alias("match"),
        F.count(F.lit(1)).alias("rows"),
    )
    mismatch = F.col("rows") - F.col("match")
    return counted.select(
        F.col("column_name").alias("column"),
        "match",
        mismatch.alias("mismatch"),
        (F.col("match") / F.col("rows")).alias("match_percentage"),
        (mismatch / F.col("rows")).alias("mismatch_percentage"),
    )


def _sum_over(columns: Sequence[str], test) -> Column:
    """Number of columns of a row for which the test holds."""
    total = F.lit(0)
    for c in columns:
        total = total + F.when(test(c), 1).otherwise(0)
    return F.coalesce(F.sum(total), F.lit(0)).cast("bigint")


def cell_accuracy(pairs: DataFrame) -> DataFrame:
    """Correct, wrong and all cells; a missing value on either side is never correct."""
    columns = _columns(pairs)
    counted = pairs.agg(
        _sum_over(columns, lambda c: F.col(c) == F.col(f"true_{c}")).alias("correct_cells"),
        (F.count(F.lit(1)) * len(columns)).alias("total_cells"),
    )
    accuracy = F.try_divide(F.col("correct_cells"), F.col("total_cells"))
    return counted.select(
        "correct_cells",
        (F.col("total_cells") - F.col("correct_cells")).alias("error_cells"),
        "total_cells",
        accuracy.alias("accuracy"),
        (1 - accuracy).alias("error_rate"),
    )


def drilldown(pairs: DataFrame, classes: DataFrame, column: str, wanted: str) -> DataFrame:
    """Dirty and true values of one column where its error class is the wanted one."""
    hits = classes.where(F.col(column) == wanted).select("row_id")
    return pairs.join(hits, "row_id").select(
        "row_id", column, F.col(f"true_{column}").alias(f"target:{column}")
    )
