"""Column lists and read schemas shared by the jobs."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column names of the published tables.
PAIR_COLUMNS = ["name", "street", "house", "city", "postalcode", "state", "country", "countrycode"]
TARGET_COLUMNS = [f"target_{c}" for c in PAIR_COLUMNS]
DATASET_COLUMNS = [
    "name", "house_number", "road", "postcode", "locality", "region", "country", "country_code",
]
PAIR_TO_DATASET = {
    "name": "name",
    "house": "house_number",
    "street": "road",
    "postalcode": "postcode",
    "city": "locality",
    "state": "region",
    "country": "country",
    "countrycode": "country_code",
}
QUERY_FIELDS = ["name", "street", "city", "postalcode", "country", "state"]
GEOCODING_FIELDS = [
    "name", "street", "housenumber", "city", "state", "country", "postcode", "country_code",
]

PAIR_SCHEMA = strings(*PAIR_COLUMNS, *TARGET_COLUMNS)
METADATA_SCHEMA = strings("url", "warc_rec_id", "warc_date")
GEOCODING_SCHEMA = strings(*GEOCODING_FIELDS)
OSM_SCHEMA = T.StructType(
    [T.StructField("properties", T.StructType([T.StructField("geocoding", GEOCODING_SCHEMA)]))]
)
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("data", T.VariantType()),
        T.StructField("crawl_metadata", METADATA_SCHEMA),
    ]
)
TRIPLE_SCHEMA = T.StructType(
    [
        T.StructField("osm", OSM_SCHEMA),
        T.StructField("crawl", RECORD_SCHEMA),
        T.StructField(
            "address_query",
            T.StructType([T.StructField(f, T.VariantType()) for f in QUERY_FIELDS]),
        ),
    ]
)
ARCHIVE_SCHEMA = T.StructType(
    [
        T.StructField("file_id", T.StringType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("rec_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("warc_rec_id", T.StringType()),
        T.StructField("warc_date", T.StringType()),
        T.StructField("http_content_type", T.StringType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)
