"""From archive records to parsed JSON-LD documents.

Every step is narrow: a whole archive is extracted inside the task that reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.functions import content, jsonld
from streetloom.operators.tables import bind


def html_responses(records: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Response records whose media type mentions html or xml.

    ``ignore_case`` tests the whole header in lower case instead of the media type as written.
    """
    header = F.col("http_content_type")
    tested = F.lower(header) if ignore_case else content.media_type(header)
    return records.where((F.col("rec_type") == "response") & content.is_markup(tested))


def content_type_columns(records: DataFrame) -> DataFrame:
    header = F.col("http_content_type")
    return records.withColumns(
        {"media_type": content.media_type(header), "charset": content.charset(header)}
    )


def crawl_metadata() -> Column:
    """The envelope that stays with a record through all steps."""
    return F.struct(
        F.col("target_uri").alias("url"), F.col("warc_rec_id"), F.col("warc_date")
    ).alias("crawl_metadata")


def decode_bodies(records: DataFrame) -> DataFrame:
    """Replace the body bytes by text in ``data``; unknown charsets are marked."""
    named = bind(records, {"charset": content.charset(F.col("http_content_type"))})
    decoded = named.withColumn("decoded", content.decode_body(F.col("body"), F.col("charset")))
    return bind(decoded, {"decoded": F.col("decoded")}).select(
        *[c for c in records.columns if c != "body"],
        "charset",
        F.col("decoded.known").alias("charset_known"),
        F.col("decoded.text").alias("data"),
        crawl_metadata(),
    )


def decode_bodies_strict(records: DataFrame, charset: Column) -> DataFrame:
    """Keep only the bodies that fit their charset."""
    text = content.decode_body_strict(F.col("body"), charset)
    return records.withColumn("data", text).where(F.col("data").isNotNull()).drop("body")


def mentions_address(records: DataFrame, column: str = "data") -> DataFrame:
    """Cheap substring test before the costly parsers."""
    return records.where(F.lower(F.col(column)).contains("postaladdress"))


def mentions_address_member(records: DataFrame, column: str = "body") -> DataFrame:
    """Older form of the test: the body bytes hold the quoted word ``"address"``."""
    return records.where(
        F.lower(content.latin1(F.col(column))).contains(content.ADDRESS_MARK)
    )


def ld_json_scripts(pages: DataFrame, column: str = "data", parser: bool = False) -> DataFrame:
    """One row per JSON-LD script of a page; pages that are JSON themselves are left out.

    ``parser`` looks for scripts with an HTML parser instead of a pattern.
    """
    found = jsonld.script_texts_parsed if parser else jsonld.script_texts
    page = F.col(column)
    texts = F.when(~jsonld.is_json(page), found(page))
    others = [c for c in pages.columns if c != column]
    return pages.select(*others, F.explode(texts).alias(column))


def json_records(records: DataFrame, column: str = "data") -> DataFrame:
    """Parse the text to a variant; rows that are not one JSON document are dropped."""
    others = [c for c in records.columns if c != column]
    parsed = F.array_compact(F.array(jsonld.parse_json(F.col(column))))
    return records.select(*others, F.explode(parsed).alias(column))


def windowed_pages(records: DataFrame) -> DataFrame:
    """Older page rows: a window of bytes around the address marks plus flat metadata."""
    kept = mentions_address_member(html_responses(records, ignore_case=True))
    return kept.select(
        content.address_window(F.col("body")).alias("content"),
        F.col("target_uri").alias("url"),
        content.sniff_charset(F.col("body")).alias("content_charset"),
        F.col("ordinal").alias("offset"),
        F.col("warc_rec_id"),
        F.col("warc_date"),
    )
