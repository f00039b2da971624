"""Cleaning of text columns, step by step.

Each step is kept apart from the next, so a value is cleaned once however often later steps
use it, and all columns share one trip to Python per step.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.functions import text
from streetloom.operators.tables import bind


def _step(df: DataFrame, columns: Sequence[str], function: Callable[[Column], Column]) -> DataFrame:
    cleaned = df.withColumns({c: function(F.col(f"`{c}`")) for c in columns})
    bound = bind(cleaned, {c: F.col(f"`{c}`") for c in columns})
    return bound.select(*[f"`{c}`" for c in df.columns])


def unescape(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Slashes, unicode escapes and HTML entities."""
    slashed = _step(df, columns, text.unescape_slashes)
    return _step(_step(slashed, columns, text.unicode_unescape), columns, text.html_unescape)


def clean_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unescape, turn new lines into spaces, trim; blank text becomes null."""
    return _step(unescape(df, columns), columns, text.clean_whitespace)
