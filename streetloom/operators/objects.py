"""From parsed JSON documents to address queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.functions import jsonld
from streetloom.operators.tables import bind
from streetloom.schemas import QUERY_FIELDS

# Where the parts of an address query stand in a JSON-LD object.
ADDRESS_PATHS = {
    "street": "$.address.streetAddress",
    "city": "$.address.addressLocality",
    "postalcode": "$.address.postalCode",
    "country": "$.address.addressCountry",
    "state": "$.address.addressRegion",
}
# Request parameter names and the options sent with every request.
PARAMETER_NAMES = {
    "name": "amenity",
    "street": "street",
    "city": "city",
    "state": "state",
    "country": "country",
    "postalcode": "postalcode",
}
REQUEST_OPTIONS = {
    "format": "geocodejson",
    "limit": "1",
    "addressdetails": "1",
    "namedetails": "1",
    "extratags": "1",
}


def nested_objects(
    records: DataFrame,
    column: str = "data",
    condition: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per object anywhere in the document, the root included; other columns stay.

    ``condition`` receives an object as a column and keeps the objects it is true for.
    """
    others = [c for c in records.columns if c != column]
    found = jsonld.sub_objects(F.col(column), condition)
    return records.select(*others, F.explode(found).alias(column))


def address_objects(records: DataFrame, column: str = "data") -> DataFrame:
    """Objects that carry a postal address."""
    return nested_objects(records, column, jsonld.has_postal_address)


def address_query(objects: DataFrame, column: str = "data") -> DataFrame:
    """Add ``address_query``: the six raw values of a look-up, not yet normalised."""
    node = F.col(column)
    name, legal = jsonld.field(node, "$.name"), jsonld.field(node, "$.legalName")
    values = {"name": F.when(jsonld.is_falsy(name), legal).otherwise(name)}
    values |= {part: jsonld.field(node, path) for part, path in ADDRESS_PATHS.items()}
    query = F.struct(*[values[f].alias(f) for f in QUERY_FIELDS])
    return bind(objects, {"address_query": query})


def normalised_query(queries: DataFrame) -> DataFrame:
    """Add the six query parts as text columns; blank text becomes null."""
    parts = {f: F.col(f"address_query.{f}") for f in QUERY_FIELDS}
    texts = bind(queries, {"_texts": jsonld.value_texts(parts, blank_as_null=True)})
    return texts.select(*queries.columns, "_texts.*")


def query_params(queries: DataFrame) -> DataFrame:
    """Drop empty parts and empty queries; add ``params`` and the encoded ``request``."""
    entries = [
        part
        for field, parameter in PARAMETER_NAMES.items()
        for part in (F.lit(parameter), F.col(field))
    ]
    params = F.map_filter(
        F.create_map(*entries), lambda _, v: v.isNotNull() & (v != "")
    )
    fixed = "&".join(f"{k}={v}" for k, v in REQUEST_OPTIONS.items())
    encoded = F.transform(
        F.map_entries("params"), lambda e: F.concat(e["key"], F.lit("="), F.url_encode(e["value"]))
    )
    return (
        bind(queries, {"params": params})
        .where(F.size("params") > 0)
        .withColumn("request", F.concat_ws("&", F.lit(fixed), F.array_join(encoded, "&")))
    )
