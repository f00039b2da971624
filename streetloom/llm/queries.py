"""The queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streetloom.llm import sql
from streetloom.llm.bpe import encoded
from streetloom.llm.chat import digests, formatted
from streetloom.llm.fill_middle import fill_in_middle
from streetloom.llm.html_text import extracted
from streetloom.llm.language_model import language_scores
from streetloom.llm.line_dedup import line_dedup
from streetloom.llm.merkle import merkle_manifest
from streetloom.llm.mixing import mixture
from streetloom.llm.neighbours import nearest
from streetloom.llm.packing import packed
from streetloom.llm.quality import quality
from streetloom.llm.secrets import secrets
from streetloom.llm.simhash import near_duplicates


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    """The path of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: A conversation whose texts consist of strings that other templates use as marks.
MARKS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = spark.createDataFrame(MARKS, "conv_id long, turn long, role string, text string")
    return digests(formatted(spark, rows.unionByName(marks), byte_bpe()))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return nearest(spark, rows, rows.where("vec_id % 50 = 0"), k=5)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, _table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(spark, _table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(spark, _table(spark, sf_dir, "documents"))


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, _table(spark, sf_dir, "documents"), byte_bpe())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark, _table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(spark, _table(spark, sf_dir, "documents"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(spark, _table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark, _table(spark, sf_dir, "pages"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(spark, _table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(spark, _table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark, _table(spark, sf_dir, "documents"), byte_bpe())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_chat_format, op2_nearest_neighbours, op3_simhash_near_dedup, op4_lm_scoring,
        op5_source_mixing, op6_bpe_codec, op7_quality_rules, op8_line_dedup, op9_secret_scans, op10_html_extraction,
        op11_fill_in_middle, op12_merkle_manifest, op13_packing,
    )
}
ORACLES: dict[str, str] = {
    "op7_quality_rules": sql.QUALITY,
    "op8_line_dedup": sql.LINE_DEDUP,
    "op9_secret_scans": sql.SECRETS,
    "op11_fill_in_middle": sql.FILL_IN_MIDDLE,
    "op12_merkle_manifest": sql.MERKLE_MANIFEST,
}
