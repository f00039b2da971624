"""Deletion of repeated runs of lines, found with a suffix array over sequences of line ids.

Lines without a word are no part of the sequences and always stay.  The other lines of each
document form its sequence.  Prefix doubling gives every position the rank of its first 1, 2,
4 … lines among all positions (the suffix array, cut at the depth that is needed); a position
whose prefix is unique leaves at once, so later rounds only hold repeated prefixes.  An
interval of the suffix array with a common prefix of m lines is named by the ranks of two
blocks of a power of two that cover the m lines.

A run of lines with at least ``min_words`` words that occurs more than once is kept where it
occurs first (smallest doc_id, then place in the text) and deleted elsewhere, also within one
document.  Every line of a maximal repeated run lies in a shortest run of enough words that
starts or ends at one of its lines, so the intervals of these shortest runs are all that is
needed, and no prefix longer than ``min_words`` lines matters.

Defined results: a null text stays null; a text all of whose lines are later copies becomes
empty, the row stays; of repeated rows the first keeps its text; null doc_ids come last; an
empty table gives an empty result; extra columns are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetloom.llm.common import (
    NOT_SPACES, column_of, let, qualified, release, restored, staged,
)

#: Runs of fewer words are left alone.
MIN_WORDS = 50
#: Keys are ranked within this many ranges, whose sizes are added up first.
RANGES = 4096


def _least_lines(rows: Column, min_words: int) -> Column:
    """How many of ``rows`` (from the first on) hold ``min_words`` words; null: not enough."""
    return F.aggregate(
        rows,
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("m")),
        lambda acc, x: F.when(acc["sum"] >= min_words, acc).otherwise(
            F.struct((acc["sum"] + x["w"]).alias("sum"), (acc["m"] + 1).alias("m"))
        ),
        lambda acc: F.when(acc["sum"] >= min_words, acc["m"]),
    )


def _lines(docs: DataFrame, text: str, min_words: int) -> DataFrame:
    """Sequence positions: __rid, __ord, i, line id (a, b), lines of the shortest runs."""
    entries = F.filter(
        F.transform(
            F.split(F.col(text), "\n"),
            lambda x: F.struct(
                F.xxhash64(x).alias("a"),
                F.xxhash64(F.lit(1), x).alias("b"),
                F.regexp_count(x, F.lit(NOT_SPACES)).alias("w"),
            ),
        ),
        lambda e: e["w"] > 0,
    )

    def with_runs(rows):
        return F.transform(
            rows,
            lambda x, i: F.struct(
                x["a"].alias("a"),
                x["b"].alias("b"),
                _least_lines(F.slice(rows, i + 1, F.lit(min_words)), min_words).alias("ahead"),
                _least_lines(
                    F.reverse(
                        F.slice(
                            rows,
                            F.greatest(i + 2 - min_words, F.lit(1)),
                            F.least(i + 1, F.lit(min_words)),
                        )
                    ),
                    min_words,
                ).alias("back"),
            ),
        )

    df = docs.where(F.col(text).isNotNull()).select(
        "__rid", "__ord", F.posexplode(let(entries, with_runs)).alias("i", "e")
    )
    return df.select("__rid", "__ord", "i", "e.*")


def _first_ranks(lines: DataFrame) -> DataFrame:
    """Repeated line ids and their ranks among all repeated positions."""
    keys = lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = keys.withColumn("part", F.shiftright("a", 52))
    sums = keys.groupBy("part").agg(F.sum("n").alias("all"))
    before = sums.select(
        "part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("before")
    )
    within = F.sum("n").over(Window.partitionBy("part").orderBy("a", "b")) - F.col("n")
    return keys.withColumn("within", within).join(before, "part").select(
        "a", "b", (F.col("before") + F.col("within")).alias("rank")
    )


def _next_ranks(pairs: DataFrame, total: int) -> DataFrame:
    """Repeated pairs of ranks (a, b) and the rank of each.

    The rank is that of ``a`` plus the number of positions in its group with a smaller ``b``.
    The group is cut into ranges of ``b``, so no group has to pass through one task.
    """
    keys = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = keys.withColumn("part", (F.col("b") * RANGES / F.lit(max(total, 1))).cast("int"))
    sums = keys.groupBy("a", "part").agg(F.sum("n").alias("all"))
    upto = F.sum("all").over(Window.partitionBy("a").orderBy("part"))
    before = sums.select("a", "part", (upto - F.col("all")).alias("before"))
    within = F.sum("n").over(Window.partitionBy("a", "part").orderBy("b")) - F.col("n")
    return keys.withColumn("within", within).join(before, ["a", "part"]).select(
        "a", "b", (F.col("a") + F.col("before") + F.col("within")).alias("rank")
    )


def suffix_ranks(
    spark: SparkSession, lines: DataFrame, depth: int, paths: list
) -> tuple[DataFrame, int]:
    """Ranks of repeated prefixes: (level, __rid, i, rank) for 2^level lines up to ``depth``."""
    rows = lines.select("__rid", "i", "a", "b").join(_first_ranks(lines), ["a", "b"])
    rows = staged(spark, rows.select("__rid", "i", "rank"), "ranks", paths)
    total = rows.count()
    levels, level = [rows.withColumn("level", F.lit(0))], 0
    while 2 ** (level + 1) <= depth:
        after = rows.select("__rid", (F.col("i") - 2**level).alias("i"), F.col("rank").alias("b"))
        pairs = rows.withColumnRenamed("rank", "a").join(after, ["__rid", "i"])
        rows = pairs.join(_next_ranks(pairs, total), ["a", "b"]).select("__rid", "i", "rank")
        rows, level = staged(spark, rows, "ranks", paths), level + 1
        levels.append(rows.withColumn("level", F.lit(level)))
    ranks = levels[0]
    for more in levels[1:]:
        ranks = ranks.unionByName(more)
    return ranks, level


def later_copies(
    spark: SparkSession, lines: DataFrame, min_words: int, paths: list
) -> DataFrame:
    """Runs to delete: (__rid, start, m), each a later copy of an earlier run."""
    ranks, top = suffix_ranks(spark, lines, min_words, paths)
    runs = lines.select(
        "__rid", "__ord",
        F.explode(
            F.array(
                F.struct(F.col("i").alias("start"), F.col("ahead").alias("m")),
                F.struct((F.col("i") - F.col("back") + 1).alias("start"), F.col("back").alias("m")),
            )
        ).alias("r"),
    ).where("r.m is not null")
    runs = runs.select("__rid", "__ord", "r.start", "r.m").distinct()
    level = sum((F.col("m") >= 2**k).cast("int") for k in range(1, top + 1)) if top else F.lit(0)
    runs = runs.withColumn("level", level)
    runs = runs.withColumn(
        "last", (F.col("start") + F.col("m") - F.pow(F.lit(2), F.col("level"))).cast("int")
    )
    head = ranks.select("level", "__rid", F.col("i").alias("start"), F.col("rank").alias("x"))
    tail = ranks.select("level", "__rid", F.col("i").alias("last"), F.col("rank").alias("y"))
    named = runs.join(head, ["level", "__rid", "start"]).join(tail, ["level", "__rid", "last"])
    named = named.select(
        "__rid", "start", "m", "x", "y", F.struct("__ord", "__rid", "start").alias("place")
    )
    named = staged(spark, named, "runs", paths)
    intervals = named.groupBy("m", "x", "y").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    return named.join(intervals.drop("n"), ["m", "x", "y"]).where("place != first").select(
        "__rid", "start", "m"
    )


def _kept_text(text: Column, runs: Column) -> Column:
    """The text without the sequence positions that ``runs`` (start, m) cover."""
    gone = F.array_distinct(
        F.flatten(F.transform(runs, lambda r: F.sequence(r["start"], r["start"] + r["m"] - 1)))
    )

    def cut(all_lines):
        places = F.filter(
            F.transform(
                all_lines,
                lambda x, p: F.when(x.rlike(r"[^\x20\x09-\x0D]"), p),
            ),
            lambda p: p.isNotNull(),
        )
        dead = let(places, lambda ps: F.transform(gone, lambda i: F.get(ps, i)))
        kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), dead)
        return F.struct(
            F.array_join(F.transform(kept, lambda p: F.get(all_lines, p)), "\n").alias("text"),
            F.size(gone).cast("long").alias("n_deleted"),
        )

    return let(F.split(text, "\n"), cut)


def deduplicated(
    spark: SparkSession, docs: DataFrame, carry: list[str], min_words: int = MIN_WORDS
) -> tuple[DataFrame, list[str]]:
    """Rows (renamed columns, ``__text``, ``__deleted``) and the names of the carried columns."""
    paths: list = []
    renamed, names = qualified(docs.select(*carry, "text", "doc_id"))
    text, doc_id = f"__in{len(carry)}", f"__in{len(carry) + 1}"
    rows = staged(spark, renamed.withColumn("__rid", F.monotonically_increasing_id()), "lines")
    rows = rows.withColumn("__ord", F.struct(F.col(doc_id).isNull(), doc_id))
    lines = staged(spark, _lines(rows, text, min_words), "sequences", paths)
    runs = later_copies(spark, lines, min_words, paths)
    runs = runs.groupBy("__rid").agg(F.collect_list(F.struct("start", "m")).alias("__runs"))
    runs = staged(spark, runs, "copies")
    release(spark, paths)
    # the table of copies grows with the corpus and is never broadcast
    joined = rows.join(runs.hint("merge"), "__rid", "left")
    cut = F.when(F.col("__runs").isNotNull(), _kept_text(F.col(text), F.col("__runs")))
    joined = joined.withColumn("__cut", cut)
    out = joined.withColumns(
        {
            "__text": F.when(F.col("__cut").isNotNull(), F.col("__cut.text")).otherwise(F.col(text)),
            "__deleted": F.coalesce(F.col("__cut.n_deleted"), F.lit(0).cast("long")),
        }
    )
    return out, names[: len(carry)]


def line_dedup(spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, the number of deleted lines, and the text that stays."""
    rows, names = deduplicated(spark, docs, ["doc_id"], min_words)
    return restored(
        rows, names, F.col("__deleted").alias("n_deleted"), F.col("__text").alias("text")
    )


def deduplicated_documents(
    spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS
) -> DataFrame:
    """The documents, all columns, with later copies of line runs deleted from the text.

    A column ``n_chars`` follows the text.
    """
    rows, names = deduplicated(spark, docs, docs.columns, min_words)
    rows = rows.withColumn(column_of(names, "text"), F.col("__text"))
    if "n_chars" in names:
        rows = rows.withColumn(
            column_of(names, "n_chars"),
            F.when(F.col("__deleted") > 0, F.length("__text").cast("long")).otherwise(
                F.col(column_of(names, "n_chars"))
            ),
        )
    return restored(rows, names)
