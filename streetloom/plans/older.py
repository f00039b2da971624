"""The older flat form of the jobs: extract rows, clean them, align them with look-up answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetloom.functions import address, jsonld, text
from streetloom.functions.similarity import nearest_candidate
from streetloom.operators import cleaning, tables

# Columns of the flat rows and where they stand in a JSON-LD object.
FLAT_PATHS = {
    "name": "$.name",
    "street": "$.address.streetAddress",
    "locality": "$.address.addressLocality",
    "postalCode": "$.address.postalCode",
    "region": "$.address.addressRegion",
    "country": "$.address.addressCountry",
    "postOfficeBoxNumber": "$.address.postOfficeBoxNumber",
}
# Columns that identify a row.
KEY_COLUMNS = ["name", "street", "locality", "postalCode", "country", "region"]

# Columns kept for alignment, in output order.
KEPT_COLUMNS = [
    "name", "osm:name", "osm:address:amenity",
    "street", "parsed:house_number", "osm:address:house_number", "parsed:road", "osm:address:road",
    "postalCode", "osm:address:postcode",
    "locality", "osm:address:city", "osm:address:town", "osm:address:village",
    "osm:address:borough", "osm:address:neighbourhood", "osm:address:hamlet",
    "osm:address:municipality",
    "country", "osm:address:country", "osm:address:country_code",
    "region", "osm:address:state", "osm:address:county", "osm:address:region",
    "osm:address:state_district", "osm:address:province", "osm:address:ISO3166-2-lvl4",
    "url", "osm:osm_id", "osm:osm_type", "osm:place_rank", "osm:extratags", "osm:lat", "osm:lon",
]
# Kinds of map objects, and the columns a town or region is taken from, in order.
OSM_TYPES = ["way", "node", "relation"]
LOCALITY_PREFERRED = ["osm:address:city", "osm:address:town"]
LOCALITY_BACKUP = [
    "osm:address:village", "osm:address:borough", "osm:address:neighbourhood",
    "osm:address:hamlet", "osm:address:county",
]
REGION_PREFERRED = ["osm:address:state", "osm:address:region"]
REGION_BACKUP = ["osm:address:county", "osm:address:state_district", "osm:address:province"]


def flatten_lists(df: DataFrame, column: str) -> DataFrame:
    """One row per element of a list column of structs."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.inline(column))


def address_rows(objects: DataFrame, url: str = "crawl_metadata.url") -> DataFrame:
    """Flat text columns of objects with an address."""
    values = {c: jsonld.field(F.col("data"), path) for c, path in FLAT_PATHS.items()}
    texts = tables.bind(objects, {"_texts": jsonld.value_texts(values)})
    return texts.select("_texts.*", F.col(url).alias("url"))


def clean_rows(rows: DataFrame, order: Sequence[str] = ("url",)) -> DataFrame:
    """Clean the text columns, drop rows without a usable street or locality, drop copies.

    Copies are rows that agree in all but ``url``; the first by ``order`` stays.
    """
    flat = tables.map_strings(_tidy(rows).where(_usable()), text.collapse_first_space)
    return tables.dedupe_keep_first(flat, ignore=["url"], order=list(order))


def clean_counts(rows: DataFrame, order: Sequence[str] = ("url",)) -> DataFrame:
    """(stage, rows) before and after `clean_rows`, from one pass over the rows.

    Rows that are dropped fall into one group, which is counted before the shuffle.
    """
    flat = tables.map_strings(_tidy(rows), text.collapse_first_space)
    keys = [F.col(f"`{c}`") for c in flat.columns if c != "url" and c not in order]
    groups = flat.groupBy(F.when(_usable(), F.struct(*keys)).alias("_row")).agg(
        F.count(F.lit(1)).alias("_copies")
    )
    totals = groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("before"), F.count("_row").alias("after")
    )
    stages = [
        F.struct(F.lit(f"clean:count_{c}").alias("stage"), F.col(c).alias("rows"))
        for c in ("before", "after")
    ]
    return totals.select(F.inline(F.array(*stages)))


def _tidy(rows: DataFrame) -> DataFrame:
    kept = rows.drop("postOfficeBoxNumber")
    plain = cleaning.unescape(kept, tables.string_columns(kept, exclude=["url"]))
    return tables.map_strings(plain, text.blank_to_null, exclude=["url"])


def _usable():
    return text.has_alnum(F.col("locality")) & text.has_alnum(F.col("street"))


def unpack_wikidata(rows: DataFrame) -> DataFrame:
    url = address.wikidata_url(F.col("`osm:extratags`.wikidata"))
    return rows.withColumn("osm:wikidata", url).drop("osm:extratags")


def typed_columns(rows: DataFrame) -> DataFrame:
    """Coordinates as numbers; an object type outside the known ones is an error."""
    kind = F.col("`osm:osm_type`")
    checked = F.when(kind.isNull() | kind.isin(OSM_TYPES), kind).otherwise(
        F.raise_error(F.concat(F.lit("unknown object type: "), kind)).cast("string")
    )
    return rows.withColumns(
        {
            "osm:osm_type": checked,
            "osm:lat": F.col("`osm:lat`").cast("double"),
            "osm:lon": F.col("`osm:lon`").cast("double"),
        }
    )


def with_nearest(
    rows: DataFrame, query: str, new: str, preferred: Sequence[str], backup: Sequence[str]
) -> DataFrame:
    def present(names):
        return [F.col(f"`{c}`") for c in names if c in rows.columns]

    return rows.withColumn(new, nearest_candidate(F.col(query), present(preferred), present(backup)))


def align_validated(rows: DataFrame) -> DataFrame:
    """Rows with an answer, brought into one line with it: keys, types, nearest names."""
    found = tables.select_existing(rows.na.drop(subset=["`osm:osm_id`"]), KEPT_COLUMNS)
    keyed = found.withColumn("hash", address.address_key(*map(F.col, KEY_COLUMNS)))
    linked = unpack_wikidata(keyed) if "osm:extratags" in keyed.columns else keyed
    split = tables.bind(linked, {"_parts": address.split_street(F.col("street"))})
    typed = typed_columns(split).withColumns(
        {
            "parsed:road": F.col("_parts.road"),
            "parsed:house_number": F.col("_parts.house"),
            "osm:name": F.nullif(F.col("`osm:name`"), F.lit("")),
            "country_code": address.country_code(F.col("country")),
        }
    ).drop("_parts")
    near = with_nearest(typed, "locality", "clean:locality", LOCALITY_PREFERRED, LOCALITY_BACKUP)
    return with_nearest(near, "region", "clean:region", REGION_PREFERRED, REGION_BACKUP)
