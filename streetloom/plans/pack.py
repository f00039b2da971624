"""Validated triples to the published data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.operators import pairs, tables
from streetloom.schemas import PAIR_COLUMNS, PAIR_TO_DATASET, TARGET_COLUMNS
from streetloom.sources import distinct, files

# Sizes of the published samples.
SAMPLE_SIZES = {"2k": 2_400, "24k": 24_000, "240k": 240_000}


def pack_sections(triples: DataFrame) -> DataFrame:
    """Distinct pairs per section; ``triples`` carries a ``section`` column."""
    return pairs.pack_pairs(triples).distinct()


def pack_dataset(triples: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """Distinct pairs with complete targets."""
    packed = pairs.pack_pairs(triples.select("osm", "address_query"))
    return pairs.complete_pairs(packed, blank_as_null)


def dataset_variant(
    packed: DataFrame, named: bool = True, size: int | str | None = None
) -> DataFrame:
    """A published variant of the packed pairs: with or without names, whole or an exact sample.

    ``size`` is a number of rows or the name of a published sample.
    """
    kept = packed if named else pairs.without_name(packed)
    dataset = pairs.complete_pairs(kept)
    rows = SAMPLE_SIZES[size] if isinstance(size, str) else size
    return tables.exact_sample(dataset, rows) if rows else dataset


def first_version(dataset: DataFrame) -> DataFrame:
    """The data set under the column names of its first version."""
    names = PAIR_TO_DATASET | {f"target_{a}": f"target_{b}" for a, b in PAIR_TO_DATASET.items()}
    return dataset.select(*[F.col(c).alias(names.get(c, c)) for c in dataset.columns])


def run(spark: SparkSession, triples: DataFrame, out: str) -> None:
    """Sections, data set, and the value and target CSV files aligned by ``row_id``."""
    files.write_sections(pack_sections(triples), f"{out}/sections")
    sections = files.read_sections(spark, f"{out}/sections").drop("section")
    dataset = tables.with_row_id(pairs.complete_pairs(sections))
    files.write_dataset(dataset, f"{out}/dataset")
    stored = files.read_dataset(spark, f"{out}/dataset")
    files.write_csv(pairs.value_table(stored), f"{out}/values")
    files.write_csv(pairs.target_table(stored), f"{out}/targets")


def extend(spark: SparkSession, triples: DataFrame, pool: str) -> None:
    """Add the pairs of new triples to a table of distinct pairs (`sources.distinct`).

    Triples that were packed before add nothing, so a run costs what its new triples cost and
    one pass over the hashes of the table.
    """
    columns = [*PAIR_COLUMNS, *TARGET_COLUMNS]
    packed = pack_dataset(triples)
    distinct.add(spark, pool, packed, columns)


def pool_dataset(spark: SparkSession, pool: str) -> DataFrame:
    """The data set of all triples that a table of pairs has taken, numbered as by `run`."""
    return tables.with_row_id(distinct.read(spark, pool, [*PAIR_COLUMNS, *TARGET_COLUMNS]))
