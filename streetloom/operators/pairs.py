"""From validated triples to the table of dirty and true address values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetloom.functions import address, jsonld
from streetloom.functions.text import blank_to_null
from streetloom.operators.tables import bind
from streetloom.schemas import PAIR_COLUMNS, TARGET_COLUMNS

# Which part of the geocoder's answer fills which target column.
TARGET_PARTS = {
    "target_name": "name",
    "target_street": "street",
    "target_house": "housenumber",
    "target_city": "city",
    "target_state": "state",
    "target_country": "country",
    "target_postalcode": "postcode",
    "target_countrycode": "country_code",
}
QUERY_PARTS = ["name", "street", "city", "state", "country", "postalcode"]


def flatten_pairs(triples: DataFrame) -> DataFrame:
    """Six query columns and eight target columns as text; triples without an answer are left out.

    Columns of the input besides the triple are kept.
    """
    others = [c for c in triples.columns if c not in ("osm", "crawl", "address_query")]
    sources = {c: f"address_query.{c}" for c in QUERY_PARTS}
    sources |= {t: f"osm.properties.geocoding.{part}" for t, part in TARGET_PARTS.items()}
    kinds = dict(zip(sources, triples.select(*sources.values()).schema))
    dynamic = {c: F.col(p) for c, p in sources.items() if isinstance(kinds[c].dataType, T.VariantType)}
    answered = triples.where(F.col("osm").isNotNull())
    if dynamic:
        answered = bind(answered, {"_texts": jsonld.value_texts(dynamic)})
    return answered.select(
        *others,
        *[F.col(f"_texts.{c}" if c in dynamic else p).alias(c) for c, p in sources.items()],
    )


def split_street_column(df: DataFrame) -> DataFrame:
    """Replace ``street`` by its road and add ``house``."""
    return bind(df, {"_parts": address.split_street(F.col("street"))}).withColumns(
        {"street": F.col("_parts.road"), "house": F.col("_parts.house")}
    ).drop("_parts")


def add_country_code(df: DataFrame) -> DataFrame:
    return df.withColumn("countrycode", address.country_code(F.col("country")))


def any_key_present(df: DataFrame) -> DataFrame:
    """Rows with a street, a city or a postal code; blank text counts as present."""
    return df.where(F.coalesce("street", "city", "postalcode").isNotNull())


def pack_pairs(triples: DataFrame) -> DataFrame:
    """The sixteen pair columns of every usable triple (plus the extra input columns)."""
    flat = any_key_present(add_country_code(split_street_column(flatten_pairs(triples))))
    others = [c for c in triples.columns if c not in ("osm", "crawl", "address_query")]
    return flat.select(*others, *PAIR_COLUMNS, *TARGET_COLUMNS)


def complete_pairs(pairs: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """Distinct pairs whose eight target values are all known.

    The null test comes first so that it also thins the input of the distinct.
    """
    if blank_as_null:
        pairs = pairs.select(*[blank_to_null(F.col(c)).alias(c) for c in pairs.columns])
    targets = [c for c in TARGET_COLUMNS if c in pairs.columns]
    return pairs.na.drop(subset=targets).distinct()


def without_name(pairs: DataFrame) -> DataFrame:
    """The seven-column variant, made before the distinct and the null test."""
    return pairs.drop("name", "target_name")


def value_table(dataset: DataFrame) -> DataFrame:
    keys = [c for c in ["row_id"] if c in dataset.columns]
    return dataset.select(*keys, *[c for c in PAIR_COLUMNS if c in dataset.columns])


def target_table(dataset: DataFrame) -> DataFrame:
    """The true values under the plain column names."""
    keys = [c for c in ["row_id"] if c in dataset.columns]
    present = [c for c in PAIR_COLUMNS if f"target_{c}" in dataset.columns]
    return dataset.select(*keys, *[F.col(f"target_{c}").alias(c) for c in present])
