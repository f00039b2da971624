"""Secret scan with an incremental ledger of contents.

A text version is addressed by the SHA-256 of its content.  The ledger holds one row per
content and scan: the rule versions that were applied and the spans they found.  A scan
reads the ledger, picks the contents with a rule version that was not yet applied, applies
just these rules, and returns new ledger rows; findings are then joined back to every path
(document row) with that content.  Raising a rule's version makes it run again everywhere.

Spans are code points, the end exclusive.  Matches of one rule are the leftmost ones that do
not overlap; those with a too short value are dropped after matching.

Defined results: a null text counts as empty; repeated rows and equal texts share one scan
and are reported each; null doc_ids are reported; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.llm.common import staged


class Rule(NamedTuple):
    """What is searched: a pattern, and the group whose length must reach ``least``."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The order of kinds is that of equal starts in reports.  Runs of a character class are
#: maximal, so a least length inside the pattern drops the same matches as a check afterwards.
RULES = [
    Rule(
        "assign", 1,
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
]
BASE = ["assign", "access", "hex"]
_SPANS = "array<struct<start:int, kind_order:int, end:int, rule:string>>"
LEDGER_SCHEMA = f"blob string, scanned array<string>, spans {_SPANS}"


def _spans(text: Column, order: int, rule: Rule) -> Column:
    """All spans of one rule in a text."""
    pattern = F.lit(rule.pattern)
    found = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("before"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
    )

    def step(acc, x):
        start = (acc["at"] + F.length(x["before"])).cast("int")
        end = (start + F.coalesce(F.length(x["match"]), F.lit(0))).cast("int")
        span = F.struct(
            start.alias("start"), F.lit(order).alias("kind_order"),
            end.alias("end"), F.lit(rule.key).alias("rule"),
        )
        good = F.coalesce(F.length(x["value"]) >= rule.least, F.lit(False))
        return F.struct(
            end.alias("at"),
            F.when(good, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
            .cast(_SPANS).alias("spans"),
        )

    spans = F.aggregate(
        found,
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans")),
        step,
        lambda acc: acc["spans"],
    )
    return F.when(text.rlike(rule.pattern), spans).otherwise(F.array().cast(_SPANS))


def blob_of(text: Column) -> Column:
    """The content address of a text."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """New ledger rows for the contents and rule versions the ledger does not hold."""
    text = F.coalesce(F.col("text"), F.lit(""))
    blobs = docs.select(text.alias("body")).groupBy(blob_of(F.col("body")).alias("blob")).agg(
        F.first("body").alias("body")
    )
    every = F.array(*[F.lit(r.key) for r in rules])
    if ledger is None:
        todo = blobs.withColumn("todo", every)
    else:
        seen = ledger.select("blob", F.explode("scanned").alias("rule")).groupBy("blob").agg(
            F.collect_set("rule").alias("seen")
        )
        todo = blobs.join(seen, "blob", "left").withColumn(
            "todo", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
        ).where(F.size("todo") > 0)
    found = F.concat(
        *[
            F.when(F.array_contains("todo", r.key), _spans(F.col("body"), k, r)).otherwise(
                F.array().cast(_SPANS)
            )
            for k, r in enumerate(rules)
        ]
    )
    return todo.select("blob", F.col("todo").alias("scanned"), found.alias("spans"))


def findings(docs: DataFrame, ledger: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """One row per document: doc_id, ``blob`` and the sorted spans of the present rules."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    hits = (
        ledger.where(F.size("spans") > 0)
        .select("blob", F.explode("spans").alias("s"))
        .where(F.array_contains(keys, F.col("s.rule")))
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set("s")).alias("spans"))
    )
    paths = docs.select("doc_id", blob_of(F.col("text")).alias("blob"))
    return paths.join(hits, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans")
    )


def _kind(span: Column) -> Column:
    return F.substring_index(span["rule"], "@", 1)


def _written(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", _kind(s), s["start"], s["end"])), ","
    )


def secrets(spark: SparkSession, docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """One row per document: counts of the base kinds, digest of their spans, and all spans."""
    new = staged(spark, scan(docs, ledger), "ledger")
    known = new if ledger is None else ledger.select(*new.columns).unionByName(new)
    rows = findings(docs, known)

    def count(kind):
        return F.size(F.filter("spans", lambda s: _kind(s) == kind)).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in BASE]
    base = F.filter("spans", lambda s: _kind(s).isin(*BASE))
    return rows.select(
        "doc_id", *counts,
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )


__all__ = ["Rule", "RULES", "LEDGER_SCHEMA", "scan", "findings", "secrets"]
