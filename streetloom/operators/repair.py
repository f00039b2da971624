"""Repairs of a dirty table and the quality of repair tools.

Null rules differ by measure and are kept as they are:
  changed cell    null counts as the text "null" on both sides
  precision       a repaired null equals a true null
  recall          a cell with a null on either side is no error
  error distance  a cell with a null on either side is an error
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.operators.tables import map_strings
from streetloom.schemas import DATASET_COLUMNS


def normalise_repair_table(table: DataFrame) -> DataFrame:
    """Drop the tuple id and turn the text ``_nan_`` back into null."""
    return map_strings(table.drop("_tid_"), lambda c: F.nullif(c, F.lit("_nan_")))


def last_updates(updates: DataFrame) -> DataFrame:
    """One value per (row, col): the one with the greatest ``ord``."""
    last = F.max(F.struct("ord", "value"))
    return updates.groupBy("row", "col").agg(last.alias("last")).select("row", "col", "last.value")


def apply_cell_updates(
    dirty: DataFrame, updates: DataFrame, columns: Sequence[str] = tuple(DATASET_COLUMNS)
) -> DataFrame:
    """Overwrite cells by (row, col); a later update wins and may set a cell to null.

    One aggregate brings the updates of a row side by side, one left join applies them.
    """
    latest = [
        F.max_by(
            F.struct("value"), F.when(F.col("col") == i, F.col("ord"))
        ).alias(f"_new_{c}")
        for i, c in enumerate(columns)
    ]
    wide = updates.groupBy(F.col("row").alias("row_id")).agg(*latest)
    merged = dirty.join(wide, "row_id", "left")
    return merged.select(
        "row_id",
        *[
            F.when(F.col(f"_new_{c}").isNotNull(), F.col(f"_new_{c}.value"))
            .otherwise(F.col(c))
            .alias(c)
            for c in columns
        ],
    )


def repair_triples(
    truth: DataFrame,
    dirty: DataFrame,
    repaired: DataFrame,
    columns: Sequence[str] = tuple(DATASET_COLUMNS),
    lower_case: bool = False,
) -> DataFrame:
    """True, dirty and repaired values side by side (``t_``, ``d_``, ``r_``) by ``row_id``.

    ``lower_case`` compares without regard to letter case, for tools that lower-case.
    """

    def marked(df: DataFrame, prefix: str) -> DataFrame:
        extra = [c for c in df.columns if c == "tool"]
        fold = F.lower if lower_case else (lambda c: c)
        return df.select(
            "row_id", *extra, *[fold(F.col(c)).alias(f"{prefix}{c}") for c in columns]
        )

    return (
        marked(repaired, "r_").join(marked(dirty, "d_"), "row_id").join(marked(truth, "t_"), "row_id")
    )


def _plain(prefix: str, c: str) -> Column:
    return F.col(f"{prefix}{c}")


def _changed(c: str, cell=_plain) -> Column:
    none = F.lit("null")
    return F.coalesce(cell("d_", c), none) != F.coalesce(cell("r_", c), none)


def _differs(a: Column, b: Column, null_is_error: bool) -> Column:
    return F.coalesce(a != b, F.lit(null_is_error))


def _count(columns: Sequence[str], test) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + F.when(test(c), 1).otherwise(0)
    return F.coalesce(F.sum(total), F.lit(0)).cast("bigint")


def _quality_counts(columns: Sequence[str], cell=_plain) -> list[Column]:
    def wrong(c):
        return _differs(cell("t_", c), cell("d_", c), False)

    def right(c):
        return _changed(c, cell) & cell("t_", c).eqNullSafe(cell("r_", c))

    return [
        _count(columns, lambda c: _changed(c, cell)).alias("changed"),
        _count(columns, right).alias("correct"),
        _count(columns, wrong).alias("errors"),
        _count(columns, lambda c: _changed(c, cell) & wrong(c)).alias("changed_errors"),
    ]


def _distance_counts(columns: Sequence[str]) -> list[Column]:
    def off(p, c):
        return _differs(_plain(p, c), _plain("t_", c), True)

    return [
        _count(columns, lambda c: off("d_", c)).alias("errors_before"),
        _count(columns, lambda c: off("r_", c)).alias("errors_after"),
    ]


def _quality() -> list[Column]:
    p = F.try_divide(F.col("correct"), F.col("changed"))
    r = F.try_divide(F.col("changed_errors"), F.col("errors"))
    f1 = F.try_divide(2 * (p * r), p + r)
    return [p.alias("precision"), r.alias("recall"), f1.alias("f1")]


def _distance() -> Column:
    gained = F.col("errors_before") - F.col("errors_after")
    return F.try_divide(gained, F.col("errors_before")).alias("edr")


def changed_cells(triples: DataFrame, columns: Sequence[str] = tuple(DATASET_COLUMNS)) -> DataFrame:
    """One row per cell the repair changed."""
    cells = F.array(
        *[
            F.when(
                _changed(c),
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.col(f"d_{c}").alias("dirty"),
                    F.col(f"r_{c}").alias("repaired"),
                    F.col(f"t_{c}").alias("truth"),
                ),
            )
            for c in columns
        ]
    )
    return triples.select("row_id", F.inline(F.array_compact(cells)))


def repair_metrics(
    triples: DataFrame,
    by: Sequence[str] = (),
    columns: Sequence[str] = tuple(DATASET_COLUMNS),
) -> DataFrame:
    """Precision, recall and F1 of a repair with the counts behind them, in one aggregate."""
    counted = triples.groupBy(*by).agg(*_quality_counts(columns))
    return counted.select(*by, "changed", "correct", "errors", "changed_errors", *_quality())


def error_distance(
    triples: DataFrame,
    by: Sequence[str] = (),
    columns: Sequence[str] = tuple(DATASET_COLUMNS),
) -> DataFrame:
    """Share of the errors a repair removed; missing values are errors."""
    counted = triples.groupBy(*by).agg(*_distance_counts(columns))
    return counted.select(*by, "errors_before", "errors_after", _distance())


def repair_report(
    truth: DataFrame,
    dirty: DataFrame,
    repairs: DataFrame,
    dataset: str,
    lower_case_tools: Sequence[str] = (),
    columns: Sequence[str] = tuple(DATASET_COLUMNS),
) -> DataFrame:
    """One line of measures per repair tool; ``repairs`` holds all tools, told apart by ``tool``.

    The values of tools that lower-case their output are folded for precision, recall and F1,
    not for the error distance.
    """
    triples = repair_triples(truth, dirty, repairs, columns)

    @cache
    def folded(prefix: str, c: str) -> Column:
        plain = _plain(prefix, c)
        if not lower_case_tools:
            return plain
        return F.when(F.col("tool").isin(list(lower_case_tools)), F.lower(plain)).otherwise(plain)

    counted = triples.groupBy("tool").agg(
        *_quality_counts(columns, folded), *_distance_counts(columns)
    )
    return counted.select(F.lit(dataset).alias("dataset"), "tool", *_quality(), _distance())
