"""Mixing sources to target weights by subset-sum fitting of document lengths.

Sources weigh 5, 2, 1, repeating in code point order (null last), and share all words; no
source gets more than three times its words, the excess goes to the others by weight.  The
target of a source is met by whole copies of it plus a subset of its documents whose lengths
add up to the rest: documents are counted by exact length, every length gives its
proportional share, lengths with the largest lost fractions give one more, and a bounded
knapsack fills what is left of the budget.  The subset is drawn by a seeded hash of the
documents of each length, so reruns agree and no group of equal length meets in one task:
hashes are counted in ranges, and only the range that holds the cut is ranked.

One row per source (its words, its target) and one per source and length pass through a
window or a group; documents never do.

Defined results: a null or empty text has size 0 and is never taken; null sources form one
source; repeated rows are separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetloom.llm.common import NOT_SPACES, qualified, restored, staged

WEIGHTS = (5, 2, 1)
#: No source is repeated more often than this.
MOST = 3
SEED = 17
#: Shares and fractions go on until so many words are left (or one document); the knapsack
#: fills these.
KNAPSACK = 4096
#: Hashes that agree above this bit are counted together: 65,536 ranges per source and length.
RANGE_SHIFT = 48


def targets(sources: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size)."""
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    df = sources.withColumn("w", F.get(F.array(*map(F.lit, weights)), place % len(weights)))
    df = df.withColumn("cap", most * F.col("source_size"))
    # sources whose cap is small for their weight stop first
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    whole = Window.partitionBy()
    df = df.withColumns(
        {
            "k": F.row_number().over(order),
            "rest": F.sum("source_size").over(whole) - (F.sum("cap").over(order) - F.col("cap")),
            "open": F.sum("w").over(whole) - (F.sum("w").over(order) - F.col("w")),
        }
    )
    stops = F.col("cap") * F.col("open") <= F.col("w") * F.col("rest")
    first = F.min(F.when(~stops, F.struct("k", "rest", "open"))).over(whole)
    df = df.withColumn("first", first)
    share = F.col("w") * F.col("first.rest") / F.col("first.open")
    below = F.col("first").isNull() | (F.col("k") < F.col("first.k"))
    return df.select(
        "source", "source_size",
        F.when(below, F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def fitted(lengths, counts, budget: int, knapsack: int = KNAPSACK) -> np.ndarray:
    """How many documents of each length to take so that the lengths add up to ``budget``.

    ``lengths`` are distinct and positive, ``counts`` bound the numbers; the sum never passes
    the budget.
    """
    lengths, counts = [int(x) for x in lengths], [int(x) for x in counts]
    total = sum(x * n for x, n in zip(lengths, counts, strict=True))
    budget = min(int(budget), total)
    take = [n * budget // total for n in counts] if total else [0] * len(counts)
    rest = budget - sum(x * n for x, n in zip(lengths, take, strict=True))
    # largest lost fractions first; ties to the longer documents
    lost = sorted(
        range(len(lengths)), key=lambda i: (-(counts[i] * budget % max(total, 1)), -lengths[i])
    )
    for i in lost:
        if rest > knapsack and lengths[i] <= rest and take[i] < counts[i]:
            take[i] += 1
            rest -= lengths[i]
    items = []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__):
        left, part = counts[i] - take[i], 1
        while left > 0 and lengths[i] * min(part, left) <= rest:
            part = min(part, left)
            items.append((i, part))
            left, part = left - part, part * 2
    reached = np.zeros(rest + 1, bool)
    reached[0] = True
    last = np.full(rest + 1, -1, np.int64)
    for k, (i, part) in enumerate(items):
        step = lengths[i] * part
        new = np.zeros_like(reached)
        new[step:] = reached[: rest + 1 - step] & ~reached[step:]
        last[new] = k
        reached |= new
        if reached[rest]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, part = items[last[at]]
        take[i] += part
        at -= lengths[i] * part
    return np.array(take, np.int64)


def _fit_group(rows: pd.DataFrame) -> pd.DataFrame:
    size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    copies = min(int(target // size), MOST)
    rest = 0 if copies == MOST else round(target - copies * size)
    out = rows[["source", "size", "n"]].copy()
    out["copies"] = copies
    out["take"] = fitted(rows["size"], rows["n"], rest)
    return out


def _cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source and length the hash (and row number) up to which documents are taken."""
    by = ["source", "size"]

    def same(a, b, names):
        out = F.lit(True)
        for name in names:
            out = out & a[name].eqNullSafe(b[name])
        return out

    counts = rows.groupBy(*by, "part").agg(F.count(F.lit(1)).alias("m"))
    upto = F.sum("m").over(Window.partitionBy(*by).orderBy("part"))
    counts = counts.withColumn("upto", upto)
    open_plan = plan.where("take > 0 and take < n").select(*by, "take")
    edge = (
        counts.join(open_plan, same(counts, open_plan, by))
        .where("take > upto - m and take <= upto")
        .select(
            counts["source"], counts["size"], "part",
            (F.col("take") - F.col("upto") + F.col("m")).alias("at"),
        )
    )
    ranked = rows.join(edge, same(rows, edge, [*by, "part"])).select(
        rows["source"], rows["size"], "at", F.struct("hash", "__rid").alias("cut"),
        F.row_number().over(
            Window.partitionBy(rows["source"], rows["size"], rows["part"]).orderBy("hash", "__rid")
        ).alias("place"),
    )
    return ranked.where("place = at").select("source", "size", "cut")


def mixed(
    spark: SparkSession, docs: DataFrame, carry: list[str], seed: int = SEED
) -> tuple[DataFrame, list[str]]:
    """Rows (renamed columns, size, source_size, target, copies) and the carried names."""
    renamed, names = qualified(docs.select(*carry, "text", "source", "doc_id"))
    text, source, doc_id = (f"__in{len(carry) + i}" for i in range(3))
    rows = renamed.select(
        *[f"__in{i}" for i in range(len(carry))],
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(NOT_SPACES)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("hash"),
        F.monotonically_increasing_id().alias("__rid"),
    )
    rows = staged(spark, rows, "mixing").withColumn("part", F.shiftright("hash", RANGE_SHIFT))
    lengths = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    lengths = staged(spark, lengths, "lengths")
    sources = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = staged(spark, targets(sources), "targets")
    joined = lengths.where("size > 0").join(
        goals.withColumnRenamed("source", "goal"), F.col("source").eqNullSafe(F.col("goal"))
    )
    kinds = joined.schema
    plan = joined.groupBy("source").applyInPandas(
        _fit_group,
        f"source {kinds['source'].dataType.simpleString()}, size long, n long, copies int, take long",
    )
    plan = staged(spark, plan, "lengths-taken")
    cuts = _cuts(rows, plan)
    plan = plan.join(
        cuts.select(F.col("source").alias("s"), F.col("size").alias("z"), "cut"),
        F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")),
        "left",
    ).select(
        F.col("source").alias("s"), F.col("size").alias("z"), "n", F.col("copies").alias("whole"),
        "take", "cut",
    )
    plan = staged(spark, plan, "cuts")
    taken = (F.col("take") == F.col("n")) | (F.struct("hash", "__rid") <= F.col("cut"))
    out = (
        rows.join(
            goals.withColumnRenamed("source", "goal"), F.col("source").eqNullSafe(F.col("goal"))
        )
        .join(
            plan.hint("merge"),  # it grows with the lengths that occur
            F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")),
            "left",
        )
        .withColumn(
            "copies",
            F.coalesce(F.col("whole"), F.lit(0)) + F.coalesce(taken, F.lit(False)).cast("int"),
        )
    )
    return out, names[: len(carry)]


def mixture(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: size, source_size, target and the words that the mix takes of it."""
    rows, names = mixed(spark, docs, ["doc_id"])
    return restored(
        rows, names, "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns."""
    rows, names = mixed(spark, docs, docs.columns)
    rows = rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return restored(rows, names)


__all__ = ["targets", "fitted", "mixture", "mixed_documents"]
