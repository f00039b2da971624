"""Column functions for postal addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from streetloom.functions.text import SPECIAL_CHARS, title_case

# A house number: digits with an optional letter, or a range of two such numbers.
_NUMBER = r"\d+\p{L}?(?:\s*[-/]\s*\d+\p{L}?)?"
# Where the number may stand, in the order the rules are tried: behind a comma, at the end,
# at the start.
_HOUSE_RULES = [
    (rf"^\s*(\S.*?)\s*,\s*({_NUMBER})\s*$", 1, 2),
    (rf"^\s*(.*\p{{L}}.*?)\s+({_NUMBER})\s*$", 1, 2),
    (rf"^\s*({_NUMBER})[\s,]+(\S.*?)\s*$", 2, 1),
]


def split_street(street: Column) -> Column:
    """struct(road, house): house number taken off a street line, both in title case."""
    road = F.regexp_extract(street, r"^\s*(.*?)\s*$", 1)
    house = F.lit(None).cast("string")
    for pattern, road_group, house_group in reversed(_HOUSE_RULES):
        hit = street.rlike(pattern)
        road = F.when(hit, F.regexp_extract(street, pattern, road_group)).otherwise(road)
        house = F.when(hit, F.regexp_extract(street, pattern, house_group)).otherwise(house)
    return F.struct(
        title_case(F.nullif(road, F.lit(""))).alias("road"),
        title_case(house).alias("house"),
    )


def country_code(country: Column) -> Column:
    """Two ASCII letters in lower case, anything else is null."""
    return F.when(country.rlike("^[A-Za-z]{2}$"), F.lower(country))


def address_key(*parts: Column) -> Column:
    """md5 of the comma-joined parts; nulls are skipped."""
    return F.md5(F.concat_ws(",", *parts))


def wikidata_url(entity: Column) -> Column:
    return F.concat(F.lit("https://www.wikidata.org/wiki/"), entity)


def url_netloc(url: Column) -> Column:
    """Network location with user and port; empty text for a URL without one."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def address_text(*parts: Column) -> Column:
    """Name, street, locality with postal code, region, country, one per line."""
    name, street, locality, postal_code, region, country = (
        F.coalesce(p, F.lit("None")) for p in parts
    )
    return F.concat_ws(
        "\n",
        name,
        street,
        F.concat(locality, F.lit(", "), postal_code),
        region,
        country,
    )


def match_text(text: Column) -> Column:
    """Form in which address fields are compared during look-up; blank becomes null."""
    spaced = F.trim(F.regexp_replace(F.lower(text), SPECIAL_CHARS, " "))
    return F.nullif(spaced, F.lit(""))
