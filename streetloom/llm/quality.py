"""Quality rules with thresholds learned from the data of each language and source.

Every document is measured with SQL functions.  Four ratios of each document go into quantile
sketches, one per language, source and ratio.  A sketch is a table of counts in log-linear
cells (five leading bits of the scaled ratio are kept, so a quantile is off by at most one
part in 32); adding counts merges sketches.  The sketch of a group with few documents is
merged with that of its language, and a language with few documents with all.  A document
fails when a ratio lies beyond the upper fence of its group, or below the lower one.

Defined results: a null or empty text has no words, all counts are 0, it fails the base rule
and does not enter the sketches.  Null languages and sources form groups of their own.
Repeated rows are measured and counted each.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetloom.llm.common import (
    column_of, let, qualified, restored, staged, words,
)

#: Width of a repeated window of words.
WINDOW = 5
#: Ratios are scaled to integers before they are put into cells.
SCALE = 10_000
#: Leading bits of a scaled ratio that a cell keeps.
BITS = 5
#: A group needs so many documents for thresholds of its own.
LEAST = 100
#: Rows of one group are joined to so many copies of its thresholds.
SALTS = 16

#: Ratio: numerator, denominator, sides that are judged, and the least distance of a fence from
#: the median in scaled units, so that a uniform group does not reject small differences.  That
#: of repeats is below the base rule's fifth of all words, so that its fence can act.
RATIOS = {
    "word_length": ("word_chars", "n_words", "both", 3 * SCALE),
    "symbols": ("n_symbols", "n_words", "high", SCALE // 10),
    "dup_lines": ("n_dup_lines", "n_lines", "high", SCALE * 3 // 10),
    "repeats": ("n_repeat_words", "n_words", "high", SCALE // 8),
}
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(array: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the text."""

    def window_hash(i):
        return F.xxhash64(*[F.element_at(array, i + k) for k in range(WINDOW)])

    def second_hash(i):
        return F.hash(*[F.element_at(array, i + k) for k in range(WINDOW)])

    def covered(places):
        # each window covers five words, or up to the start of the next repeated window
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("last")),
            lambda acc, p: F.struct(
                (acc["words"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("words"),
                p.alias("last"),
            ),
            lambda acc: acc["words"],
        )

    def marked(rows):
        # rows are sorted by hash; a window is repeated if a neighbour has the same hash
        def same(i, j):
            a, b = F.get(rows, i), F.get(rows, j)
            return F.coalesce((a["a"] == b["a"]) & (a["b"] == b["b"]), F.lit(False))

        flagged = F.filter(rows, lambda r, i: same(i, i - 1) | same(i, i + 1))
        return covered(F.sort_array(F.transform(flagged, lambda r: r["i"])))

    def counted(hashes):
        rows = F.sort_array(
            F.transform(
                hashes,
                lambda h, i: F.struct(
                    h.alias("a"), second_hash(i + 1).alias("b"), (i + 1).alias("i")
                ),
            )
        )
        return F.when(
            F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)
        ).otherwise(let(rows, marked))

    hashes = F.transform(F.sequence(F.lit(1), F.size(array) - (WINDOW - 1)), window_hash)
    return F.when(F.size(array) < WINDOW, F.lit(0)).otherwise(let(hashes, counted))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the metrics of each document to its row, as ``__q`` (a struct)."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    with_lines = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
        ),
    )
    with_words = let(
        words(F.col(text)),
        lambda x: F.struct(
            F.size(x).cast("long").alias("n"),
            F.length(F.array_join(x, "")).cast("long").alias("chars"),
            _repeat_words(x).cast("long").alias("repeats"),
        ),
    )
    df = docs.withColumns({"__w": with_words, "__l": with_lines})
    symbols = F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))
    failed = (F.col("__w.n") < 10) | (100 * F.col("__w.repeats") > 20 * F.col("__w.n"))
    return df.withColumn(
        "__q",
        F.struct(
            F.col("__w.n").alias("n_words"),
            F.col("__w.chars").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            F.col("__l.dup").alias("n_dup_lines"),
            F.col("__w.repeats").alias("n_repeat_words"),
            F.col("__l.n").alias("n_lines"),
            failed.alias("base_failed"),
        ),
    ).drop("__w", "__l")


def cell(value: Column) -> Column:
    """Lower end of the log-linear cell of a scaled ratio."""
    shift = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    step = F.pow(F.lit(2.0), shift).cast("long")
    return value - value % step


def sketches(rows: DataFrame) -> DataFrame:
    """Cells and counts (lang, source, ratio, cell, n) of rows with lang, source and ``__q``."""
    values = F.array(
        *[
            F.struct(
                F.lit(name).alias("ratio"),
                cell(F.expr(f"__q.{top} * {SCALE} div __q.{bottom}")).alias("cell"),
            )
            for name, (top, bottom, _, _) in RATIOS.items()
        ]
    )
    return (
        rows.where("not __q.base_failed and __q.n_lines > 0")
        .select("lang", "source", F.explode(values).alias("v"))
        .groupBy("lang", "source", "v.ratio", "v.cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _quartiles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Sizes and quartiles per key and ratio."""
    by = Window.partitionBy(*keys, "ratio")
    upto = F.sum("n").over(by.orderBy("cell"))
    df = cells.withColumns({"__upto": upto, "__all": F.sum("n").over(by)})

    def quantile(quarter):
        return F.min(F.when(4 * F.col("__upto") >= quarter * F.col("__all"), F.col("cell")))

    return df.groupBy(*keys, "ratio").agg(
        F.max("__all").alias("size"),
        quantile(1).alias("q1"), quantile(2).alias("q2"), quantile(3).alias("q3"),
    )


def thresholds(cells: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per language and source: a struct of limits (low, high) for each ratio.

    The fences stand three quartile distances outside the quartiles.  ``cells`` may be the
    union of sketches made at other times; counts of equal cells are added here.
    """
    cells = cells.groupBy("lang", "source", "ratio", "cell").agg(F.sum("n").alias("n"))
    keys = ["lang", "source"]
    own = _quartiles(cells, keys)
    of_lang = cells.groupBy("lang", "ratio", "cell").agg(F.sum("n").alias("n"))
    lang = _quartiles(of_lang, ["lang"])
    total = _quartiles(of_lang.groupBy("ratio", "cell").agg(F.sum("n").alias("n")), [])

    def fields(df, kind):
        return df.select(
            *[F.col(c).alias(f"{kind}_{c}") for c in df.columns if c in ("lang", "ratio")],
            F.struct("size", "q1", "q2", "q3").alias(kind),
        )

    lang, total = fields(lang, "l"), fields(total, "t")
    joined = (
        own.withColumn("o", F.struct("size", "q1", "q2", "q3"))
        .join(lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("ratio") == F.col("l_ratio")))
        .join(total, F.col("ratio") == F.col("t_ratio"))
    )
    used = F.when(F.col("o.size") >= least, F.col("o")).when(
        F.col("l.size") >= least, F.col("l")
    ).otherwise(F.col("t"))
    df = joined.withColumn("u", used)
    limits = []
    for name, (_, _, sides, room) in RATIOS.items():
        spread = 3 * (F.col("u.q3") - F.col("u.q1"))
        high = F.greatest(F.col("u.q3") + spread, F.col("u.q2") + room)
        low = F.least(F.col("u.q1") - spread, F.col("u.q2") - room)
        here = F.col("ratio") == name
        limits.append(F.max(F.when(here, high)).alias(f"{name}_high"))
        if sides == "both":
            limits.append(F.max(F.when(here, low)).alias(f"{name}_low"))
    return df.groupBy(*keys).agg(*limits)


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Join rows (lang, source, ``__q``) with their limits; adds ``__kept``.

    A group without limits (all its documents fail the base rule) needs none.  A hot group is
    spread over `SALTS` copies of its limits.
    """
    copies = limits.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    copies = copies.select(
        F.col("lang").alias("__lang"), F.col("source").alias("__source"),
        F.col("__salt").alias("__copy"), *limits.columns[2:],
    )
    salted = rows.withColumn("__salt", (F.rand(1) * SALTS).cast("int"))
    joined = salted.join(
        copies,
        F.col("lang").eqNullSafe(F.col("__lang"))
        & F.col("source").eqNullSafe(F.col("__source"))
        & (F.col("__salt") == F.col("__copy")),
        "left",
    )
    fits = F.lit(True)
    for name, (top, bottom, sides, _) in RATIOS.items():
        value = cell(F.expr(f"__q.{top} * {SCALE} div nullif(__q.{bottom}, 0)"))
        fits = fits & F.coalesce(value <= F.col(f"{name}_high"), F.lit(True))
        if sides == "both":
            fits = fits & F.coalesce(value >= F.col(f"{name}_low"), F.lit(True))
    kept = ~F.col("__q.base_failed") & fits
    return joined.select(*rows.columns, kept.alias("__kept"))


def assess(spark: SparkSession, docs: DataFrame, carry: list[str]) -> tuple[DataFrame, list[str]]:
    """Measure and judge; ``carry`` names the columns that stay.

    Returns rows (renamed columns, lang, source, ``__q``, ``__kept``) and the carried names.
    The documents are measured once; the measured rows are kept as a stage table.
    """
    renamed, names = qualified(docs.select(*carry, "text", "lang", "source"))
    text, lang, source = (f"__in{len(carry) + i}" for i in range(3))
    rows = measured(renamed.withColumns({"lang": F.col(lang), "source": F.col(source)}), text)
    rows = staged(spark, rows.drop(text, lang, source), "quality")
    # written first, so that the planner knows how small the table of limits is
    limits = staged(spark, thresholds(sketches(rows)), "limits")
    return judged(rows, limits), names[: len(carry)]


def quality(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the metrics, base_failed and the verdict ``kept``."""
    rows, names = assess(spark, docs, ["doc_id"])
    metrics = [F.col(f"__q.{m}").alias(m) for m in [*METRICS, "base_failed"]]
    return restored(rows, names, *metrics, F.col("__kept").alias("kept"))


def good_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    rows, names = assess(spark, docs, docs.columns)
    return restored(rows.where("__kept"), names)


__all__ = ["quality", "good_documents", "sketches", "thresholds", "column_of"]
