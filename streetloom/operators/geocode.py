"""Look-up of address queries in a table of places.

A query is answered by the place that agrees with it on the most telling set of fields.
The sets are tried in a fixed order (``LEVELS``); within a set the smallest place id wins.
A set that only holds a location is answered by a town or a postcode area, that is a place
without name, road and house number of its own, never by some shop of that town.
If the query names a country, only places of that country (by name or by code) count.

Every set of fields becomes one text key on both sides.  The places are reduced to one row
per key before the join, so the join never multiplies rows however many places or queries
share a key, and equal queries are looked up once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.functions.address import match_text, split_street
from streetloom.operators.tables import bind
from streetloom.session import scratch_path

# What must agree besides the location, from most to least telling, and how the location
# may be given.
CONTENTS = [
    ("name", "road", "house_number"),
    ("name", "road"),
    ("road", "house_number"),
    ("road",),
    ("name",),
    (),
]
ANCHORS = [("postcode",), ("locality", "region"), ("locality",)]
LEVELS = [content + anchor for content in CONTENTS for anchor in ANCHORS]

#: Places whose keys one task combines.
TASK_PLACES = 1 << 14

_SEP = "\x1f"
_FIELDS = ["name", "road", "house_number", "postcode", "locality", "region"]


def _level_keys(
    df: DataFrame, kept: str, country: Column, prefix: str, coarse: Column | None = None
) -> DataFrame:
    """One row (kept, match_level, key) per level whose fields are all present.

    ``coarse`` tells which rows may have the keys of locations alone (null: all).
    """
    keys = []
    for level, fields in enumerate(LEVELS):
        # concat is null if any part is
        parts = [p for f in fields for p in (F.lit(_SEP), F.col(f"{prefix}{f}"))]
        key = F.concat(F.lit(f"{level}{_SEP}"), country, *parts)
        if coarse is not None and not set(fields) - {f for a in ANCHORS for f in a}:
            key = F.when(coarse, key)
        keys.append(F.struct(F.lit(level).alias("match_level"), key.alias("key")))
    return df.select(kept, F.inline(F.array(*keys))).where(F.col("key").isNotNull())


def place_postings(places: DataFrame) -> DataFrame:
    """(key, place_id): all keys of each place."""
    countries = F.array(F.lit(""), match_text(F.col("country")), match_text(F.col("country_code")))
    matched = bind(places, {f"m_{f}": match_text(F.col(f)) for f in _FIELDS}).select(
        "place_id",
        F.explode(F.array_distinct(F.array_compact(countries))).alias("m_country"),
        *[f"m_{f}" for f in _FIELDS],
    )
    coarse = F.coalesce("m_name", "m_road", "m_house_number").isNull()
    keys = _level_keys(matched, "place_id", F.col("m_country"), "m_", coarse)
    return keys.select("key", "place_id")


def place_index(places: DataFrame) -> DataFrame:
    """(key, place_id): the one place that answers each key.

    The index depends on the places only; `streetloom.sources.places` keeps it as a table for
    repeated use.  A place has dozens of keys, which its task holds at once to combine them, so
    the places are counted and shared out first.
    """
    even = places.repartition(-(-places.count() // TASK_PLACES) or 1)
    return place_postings(even).groupBy("key").agg(F.min("place_id").alias("place_id"))


def geocode(
    queries: DataFrame,
    places: DataFrame,
    index: DataFrame | None = None,
    stage: str | None = None,
) -> DataFrame:
    """Add ``osm`` (best place or null) and ``place_id``, ``match_level`` to each query.

    ``queries`` has the text columns name, street, city, postalcode, country, state; the
    places have place_id, name, house_number, road, postcode, locality, region, country,
    country_code.  All query rows are kept.

    The queries, the index (unless one is given) and the answers are written as tables below
    ``stage``, a folder not yet in use (one in the shared scratch folder by default), and read
    back.  The queries are used twice, and whatever produces them (parsing a crawl, say) then
    runs only once; and both joins read plain tables on both sides, which lets adaptive
    execution split a key that many queries share.
    """
    stage = stage or scratch_path(queries.sparkSession, "geocode")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{stage}/{name}")
        return df.sparkSession.read.parquet(f"{stage}/{name}")

    index = stored(place_index(places), "index") if index is None else index
    split = bind(queries, {"_parts": split_street(F.col("street"))})
    asked = {
        "name": F.col("name"),
        "road": F.col("_parts.road"),
        "house_number": F.col("_parts.house"),
        "postcode": F.col("postalcode"),
        "locality": F.col("city"),
        "region": F.col("state"),
        "country": F.col("country"),
    }
    with_id = bind(split, {f"q_{f}": match_text(c) for f, c in asked.items()}).drop("_parts")
    same = F.concat_ws(_SEP, *[F.coalesce(F.col(f"q_{f}"), F.lit("\0")) for f in asked])
    with_id = stored(with_id.withColumn("query_id", F.md5(same)), "queries")

    distinct = with_id.select("query_id", *[f"q_{f}" for f in asked]).distinct()
    wanted = _level_keys(distinct, "query_id", F.coalesce(F.col("q_country"), F.lit("")), "q_")
    best = (
        wanted.join(index, "key")
        .groupBy("query_id")
        .agg(
            F.min("match_level").alias("match_level"),
            F.min_by("place_id", "match_level").alias("place_id"),
        )
    )
    feature = F.struct(
        F.struct(
            F.struct(
                F.col("name"),
                F.col("road").alias("street"),
                F.col("house_number").alias("housenumber"),
                F.col("locality").alias("city"),
                F.col("region").alias("state"),
                F.col("country"),
                F.col("postcode"),
                F.col("country_code"),
            ).alias("geocoding")
        ).alias("properties")
    )
    answers = best.join(places.select("place_id", feature.alias("osm")), "place_id")
    answers = stored(answers, "answers")
    return with_id.drop(*[f"q_{f}" for f in asked]).join(answers, "query_id", "left").drop("query_id")


def assemble_triples(looked_up: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """(osm, crawl, address_query): answer, source record, raw query; ``kept`` columns stay."""
    return looked_up.select(
        "osm", F.struct("data", "crawl_metadata").alias("crawl"), "address_query", *kept
    )


def join_by_index(addresses: DataFrame, answers: DataFrame) -> DataFrame:
    """Older form: inner join of addresses with prefixed look-up answers on ``join_index``."""
    return addresses.join(prefix_answers(answers), "join_index", "inner")


def prefix_answers(answers: DataFrame) -> DataFrame:
    """Prefix all columns but the key with ``osm:`` and spread the address struct."""
    top = [c for c in answers.columns if c not in ("join_index", "address")]
    inner = answers.schema["address"].dataType.names
    return answers.select(
        F.col("join_index").cast("bigint").alias("join_index"),
        *[F.col(f"`{c}`").alias(f"osm:{c}") for c in top],
        *[F.col(f"address.`{c}`").alias(f"osm:address:{c}") for c in inner],
    )
