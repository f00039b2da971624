"""General table operators: row numbers, exact samples, tolerant projections, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def bind(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated once, whatever later steps do with them.

    Plain projections are merged into their consumers, which copies a long expression to
    every place that uses it.  A one-element ``inline`` keeps it where it is.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    others = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*others, F.inline(F.array(row)))


_BUCKET_DIGITS = 4  # 16 ** 4 buckets of the content hash


def content_hash(columns: Sequence[str]) -> Column:
    """md5 of a row's values; null and empty text differ."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *parts))


def _hashed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    hashed = df.withColumn("_hash", content_hash(columns))
    return hashed.withColumn("_bucket", F.substring("_hash", 1, _BUCKET_DIGITS))


def _bucket_starts(hashed: DataFrame) -> DataFrame:
    """Rows in all buckets before each one: at most 65,536 rows, so one window suffices."""
    counts = hashed.groupBy("_bucket").count()
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))


def with_row_id(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number distinct rows 0, 1, 2 … in the order of their content hash.

    The number depends on the content only, so a lost task recomputes the same numbers.
    Rows are ranked inside hash buckets and shifted by the size of the buckets before; no
    task sees more than one bucket.  Expects rows without duplicates in ``columns``.
    """
    hashed = _hashed(df, columns or df.columns)
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash"))
    placed = hashed.join(F.broadcast(_bucket_starts(hashed)), "_bucket")
    return placed.select(
        (F.col("_start") + rank - 1).cast("bigint").alias("row_id"), *df.columns
    )


def exact_sample(df: DataFrame, size: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The ``size`` rows with the smallest content hash: a repeatable sample of exact size.

    Whole buckets are taken or left by their counts, only the rest is ranked, and nothing is
    sorted as a whole.  Expects rows without duplicates in ``columns``.
    """
    hashed = _hashed(df, columns or df.columns)
    starts = _bucket_starts(hashed).where(F.col("_start") < size)
    near = hashed.join(F.broadcast(starts), "_bucket")
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash"))
    ranked = near.withColumn("_rank", rank)
    return ranked.where(F.col("_start") + F.col("_rank") <= size).select(*df.columns)


def row_index(
    df: DataFrame, order: str, within: Sequence[str] = (), width: int = 1_000_000
) -> DataFrame:
    """Position of each row by a numeric ``order`` column, starting at 0, per ``within`` group.

    The order values are cut into ranges of ``width``; rows are ranked inside their range and
    shifted by the rows of the ranges before.  So a group is never ranked by a single task,
    however large it is.  Expects ``order`` to be unique inside a group.
    """
    ranged = df.withColumn("_range", F.floor(F.col(order) / width))
    keys = [*within, "_range"]
    counts = ranged.groupBy(*keys).count()
    before = Window.partitionBy(*within).orderBy("_range")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(k).alias(f"{k}_") for k in keys],
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"),
    )
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    placed = ranged.join(starts, same)
    return placed.select(*df.columns, (F.col("_start") + rank - 1).alias("row_index"))


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in df.columns])


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [n for n, kind in df.dtypes if kind == "string" and n not in exclude]


def map_strings(df: DataFrame, function, exclude: Sequence[str] = ()) -> DataFrame:
    """Apply a column function to every text column in one projection."""
    chosen = set(string_columns(df, exclude))
    return df.select(
        *[function(F.col(f"`{c}`")).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns]
    )


def lowercase_all(df: DataFrame) -> DataFrame:
    return map_strings(df, F.lower)


def dedupe_keep_first(df: DataFrame, ignore: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per distinct values of all but the ignored columns; the first by ``order`` stays.

    An aggregate with map-side combine: many copies of one row are reduced before the shuffle.
    """
    keys = [c for c in df.columns if c not in ignore and c not in order]
    first = F.min(F.struct(*order, *[c for c in ignore if c not in order])).alias("_first")
    kept = df.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(first)
    return kept.select(
        *[F.col(f"_first.`{c}`").alias(c) if c not in keys else F.col(f"`{c}`") for c in df.columns]
    )


def observe_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows on the side while the frame is used; no extra pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows) for each named frame."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(stage).alias("stage"), "rows")
        for stage, df in stages.items()
    ]
    out = counted[0]
    for other in counted[1:]:
        out = out.unionByName(other)
    return out


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; columns a frame lacks are null."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
