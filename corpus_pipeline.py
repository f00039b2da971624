"""The training-data pipeline: five stages from raw documents to token ids.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; what it returns is
written as Parquet, and read back as the documents of the next stage.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from streetloom.llm.bpe import encoded
from streetloom.llm.common import collected, release, staged
from streetloom.llm.line_dedup import deduplicated_documents
from streetloom.llm.mixing import mixed_documents
from streetloom.llm.quality import good_documents
from streetloom.llm.queries import byte_bpe
from streetloom.llm.simhash import representative_documents


_LAST: list[str] = []


def _stage(function):
    """A stage that first removes the scratch tables of the stage before.

    What that stage returned has been written by then; tables that ``docs`` still reads (a
    caller that chains stages without writing) are left.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _LAST:
            read = docs.inputFiles()
            release(spark, [p for p in _LAST if not any(p in file for file in read)])
        _LAST.clear()
        with collected(_LAST):
            return function(spark, docs, sf_dir)

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return good_documents(spark, docs)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of line runs."""
    return deduplicated_documents(spark, docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose SimHash fingerprints link."""
    return representative_documents(spark, docs)


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(spark, docs)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and digests of each document."""
    return encoded(spark, docs, byte_bpe(), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: Fingerprints, the knapsack and BPE cannot be written in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        now: list[str] = []
        docs = staged(spark, stage(spark, docs, sf_dir), f"stage-{name}", now)
        release(spark, before)
        before = now
    return STAGES[-1][1](spark, docs, sf_dir)
