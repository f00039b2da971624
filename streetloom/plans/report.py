"""Error reports on a data set and on the tools that repair it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from streetloom.operators import errors, repair
from streetloom.schemas import DATASET_COLUMNS


def error_report(
    dirty: DataFrame, truth: DataFrame, columns: Sequence[str] = tuple(DATASET_COLUMNS)
) -> dict[str, DataFrame]:
    """The tables of the error report: accuracy, per field, matrix and totals."""
    pairs = errors.pair_join(dirty, truth, columns)
    classes = errors.cell_errors(pairs)
    return {
        "accuracy": errors.cell_accuracy(pairs),
        "fields": errors.field_match_counts(classes),
        "matrix": errors.error_matrix(classes, columns),
        "totals": errors.error_type_totals(classes),
    }


def update_report(
    dirty: DataFrame,
    truth: DataFrame,
    updates: DataFrame,
    dataset: str,
    tool: str,
    columns: Sequence[str] = tuple(DATASET_COLUMNS),
) -> DataFrame:
    """Apply the updates of one tool and measure the outcome."""
    repaired = repair.apply_cell_updates(dirty, updates, columns)
    named = repaired.selectExpr("*", f"'{tool}' as tool")
    return repair.repair_report(truth, dirty, named, dataset, columns=columns)
