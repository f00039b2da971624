"""Column functions for HTTP content types, character sets and page bodies."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the character sets that Spark decodes without Python, written as
# lower case with every other character turned into an underscore.
UTF8_NAMES = ["utf_8", "utf8", "u8", "utf", "utf8_ucs2", "utf8_ucs4", "cp65001"]
LATIN1_NAMES = [
    "latin_1", "latin1", "latin", "l1", "iso_8859_1", "iso8859_1", "iso8859", "8859", "cp819",
    "ibm819", "csisolatin1", "iso_ir_100", "iso_8859_1_1987",
]
ASCII_NAMES = [
    "ascii", "us_ascii", "us", "646", "ansi_x3.4_1968", "ansi_x3.4_1986", "ansi_x3_4_1968",
    "iso646_us", "iso_646.irv_1991", "iso_ir_6", "csascii", "ibm367", "cp367",
]

# The last charset option of the header counts; its value may be quoted.
_CHARSET_OPTION = r"""(?i)^.*;\s*charset=(?:"([^"]*)"|([\w!#$%&'*+\-.^`|~]+))"""

_DECODED = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("known", T.BooleanType())]
)

# The content window kept around address markers, in bytes.  Fixed values.
ADDRESS_MARK = '"address"'
BYTES_BEFORE = 1600
BYTES_AFTER = 2400


def media_type(content_type: Column) -> Column:
    """The part before the first semicolon, trimmed, letter case kept."""
    return F.trim(F.substring_index(content_type, ";", 1))


def charset(content_type: Column) -> Column:
    """The lower-cased charset option, or null."""
    quoted = F.regexp_extract(content_type, _CHARSET_OPTION, 1)
    plain = F.regexp_extract(content_type, _CHARSET_OPTION, 2)
    return F.nullif(F.lower(F.concat(quoted, plain)), F.lit(""))


def is_markup(media: Column) -> Column:
    return media.contains("html") | media.contains("xml")


def latin1(body: Column) -> Column:
    """One character per byte, so text positions are byte positions."""
    return F.decode(body, "ISO-8859-1")


def sniff_charset(body: Column) -> Column:
    """The first charset declaration found inside a page body."""
    found = F.regexp_extract(F.lower(latin1(body)), r"""charset=['"\s]?([\w-]+)""", 1)
    return F.nullif(found, F.lit(""))


@F.pandas_udf(_DECODED)
def _decode_other(body: pd.Series, name: pd.Series) -> pd.DataFrame:
    def decode(raw, charset_name):
        if raw is None:
            return None, None
        try:
            return raw.decode(charset_name, errors="replace"), True
        except (LookupError, ValueError):
            return raw.decode("utf-8", errors="replace"), False

    rows = [decode(b, c) for b, c in zip(body, name)]
    return pd.DataFrame(rows, columns=["text", "known"], dtype=object)


@F.pandas_udf(T.StringType())
def _decode_other_strict(body: pd.Series, name: pd.Series) -> pd.Series:
    def decode(raw, charset_name):
        if raw is None:
            return None
        try:
            return raw.decode(charset_name)
        except (LookupError, ValueError):
            return None

    return pd.Series([decode(b, c) for b, c in zip(body, name)], dtype=object)


def _kind(charset_name: Column) -> Column:
    key = F.regexp_replace(F.lower(charset_name), r"[^a-z0-9.]+", "_")
    return (
        F.when(charset_name.isNull() | key.isin(UTF8_NAMES), "utf8")
        .when(key.isin(LATIN1_NAMES), "latin1")
        .when(key.isin(ASCII_NAMES), "ascii")
        .otherwise("other")
    )


def decode_body(body: Column, charset_name: Column) -> Column:
    """struct(text, known): body text with malformed bytes replaced.

    UTF-8, Latin-1 and ASCII bodies are decoded inside the JVM; only the others reach Python.
    A character set nobody knows falls back to UTF-8 and is marked ``known = false``.
    """
    kind = _kind(charset_name)
    other = _decode_other(F.when(kind == "other", body), F.when(kind == "other", charset_name))
    native = (
        F.when(kind == "utf8", F.make_valid_utf8(body.cast("string")))
        .when(kind == "latin1", latin1(body))
        .when(kind == "ascii", F.regexp_replace(latin1(body), r"[\x80-\xff]", "�"))
    )
    return F.struct(
        F.when(kind == "other", other["text"]).otherwise(native).alias("text"),
        F.when(kind == "other", other["known"]).otherwise(F.lit(True)).alias("known"),
    )


def decode_body_strict(body: Column, charset_name: Column) -> Column:
    """Body text, or null where the charset is unknown or the bytes do not fit it."""
    kind = _kind(charset_name)
    other = _decode_other_strict(
        F.when(kind == "other", body), F.when(kind == "other", charset_name)
    )
    return (
        F.when(kind == "utf8", F.try_validate_utf8(body.cast("string")))
        .when(kind == "latin1", latin1(body))
        .when((kind == "ascii") & ~latin1(body).rlike(r"[\x80-\xff]"), latin1(body))
        .when(kind == "other", other)
    )


def address_window(body: Column) -> Column:
    """Bytes from before the first to behind the last address mark.

    A window that reaches the end of the body stops one byte before it, as it always has.
    """
    lowered = F.lower(latin1(body))
    size = F.octet_length(body)
    first = F.instr(lowered, ADDRESS_MARK) - 1
    behind = F.instr(F.reverse(lowered), ADDRESS_MARK[::-1])
    last = F.when(behind > 0, size - (behind - 1) - len(ADDRESS_MARK)).otherwise(F.lit(-1))
    start = F.greatest(first - BYTES_BEFORE, F.lit(0))
    end = F.least(last + BYTES_AFTER, size - 1)
    return F.substring(body, start + 1, F.greatest(end - start, F.lit(0)))
