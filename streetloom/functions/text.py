"""Column functions for cleaning text."""

from __future__ import annotations

import codecs
import html
import json
import re
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Everything that is neither a letter nor a digit, and the characters the
# clean-up rules count as white space.
SPECIAL_CHARS = r"[^\p{L}\p{N}]+"
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"


def unescape_slashes(text: Column) -> Column:
    return F.replace(text, F.lit("\\/"), F.lit("/"))


def strip(text: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def blank_to_null(text: Column) -> Column:
    return F.when(~text.rlike(f"^{SPACE}*$"), text)


def clean_whitespace(text: Column) -> Column:
    """New lines become spaces, ends are trimmed, blank text becomes null."""
    return F.nullif(strip(F.replace(text, F.lit("\n"), F.lit(" "))), F.lit(""))


def collapse_first_space(text: Column) -> Column:
    """New lines become spaces; only the first run of white space shrinks to one space."""
    flat = F.replace(text, F.lit("\n"), F.lit(" "))
    return F.regexp_replace(flat, f"^({NOT_SPACE}*){SPACE}+", "$1 ")


def has_alnum(text: Column) -> Column:
    return text.rlike(r"[\p{L}\p{N}]")


def squash(text: Column) -> Column:
    """Lower case without special characters."""
    return F.lower(F.regexp_replace(text, SPECIAL_CHARS, ""))


def tokens(text: Column) -> Column:
    """Distinct, non-empty tokens between special characters."""
    return F.array_distinct(token_sequence(text))


def token_sequence(text: Column) -> Column:
    parts = F.split(F.regexp_replace(text, SPECIAL_CHARS, " "), " ")
    return F.filter(parts, lambda t: t != "")


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the others."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


_ESCAPE = re.compile(
    r"\\(?:u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|x[0-9a-fA-F]{2}|[0-7]{1,3}|[\\'\"abfnrtv])"
)


def _decode_escapes(text: str) -> str:
    try:
        out = _ESCAPE.sub(lambda m: codecs.decode(m.group(0), "unicode_escape"), text)
    except UnicodeDecodeError:  # a code point beyond the Unicode range: leave the text alone
        return text
    # an escaped pair of surrogates is one character: join its halves
    return out.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


@F.pandas_udf(T.StringType())
def _unicode_unescape(text: pd.Series) -> pd.Series:
    return text.map(_decode_escapes, na_action="ignore")


# A reference, or the text between two of them.
_REFERENCE = r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[^\t\n\f <&#;]{1,32};?|[^&]+|&"
# Names that count without a semicolon, also where further letters follow; the longest fits first.
_OPEN_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
# What the numbers of control characters stand for.
_CONTROLS = {n: html.unescape(f"&#{n};") for n in [*range(32), *range(127, 160)]}


def _constant(value: dict, kind: str) -> Column:
    """A constant column that is parsed once per plan."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _character(digits: Column, base: int) -> Column:
    """The character of a number; none for what is no character."""
    controls = _constant(_CONTROLS, "map<string,string>")

    def character(number: Column) -> Column:
        # the mark in front keeps a character that looks like a mark itself
        words = F.concat(F.lit("0000FEFF"), F.lpad(F.hex(number), 8, "0"))
        none = number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        return (
            F.when(number.between(32, 126), F.char(number))
            .when(number < 160, F.try_element_at(controls, number.cast("string")))
            .when(number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), "\ufffd")
            .when(none, "")
            .otherwise(F.decode(F.unhex(words), "UTF-32"))
        )

    # numbers of more than fifteen digits, zeros in front apart, are beyond all characters
    short = F.ltrim(digits, F.lit("0"))
    number = F.conv(F.left(F.concat(F.lit("0"), short), F.lit(16)), base, 10).cast("long")
    beyond = F.when(F.length(short) > 15, F.lit(0x110000)).otherwise(number)
    return _bound(beyond.cast("long"), character)


def _named(name: Column) -> Column:
    """What a name stands for: the whole of it, else its longest start that is one, else itself."""
    by_letter: dict[str, dict[str, str]] = {}
    for key, value in html5.items():
        by_letter.setdefault(key[0], {})[key] = value
    table = _constant(by_letter, "map<string,map<string,string>>")

    def known(key: Column) -> Column:
        return F.try_element_at(F.try_element_at(table, F.left(key, F.lit(1))), key)

    start = F.regexp_extract(name, f"^(?:{_OPEN_NAMES})", 0)
    rest = F.substring(name, F.length(start) + 1, F.length(name))
    return F.coalesce(known(name), F.concat(known(start), rest), F.concat(F.lit("&"), name))


def _resolved(piece: Column) -> Column:
    def digits(first: int) -> Column:
        return F.rtrim(F.substring(piece, F.lit(first), F.length(piece)), F.lit(";"))

    return (
        F.when(~piece.startswith("&") | (piece == "&"), piece)
        .when(piece.startswith("&#x") | piece.startswith("&#X"), _character(digits(4), 16))
        .when(piece.startswith("&#"), _character(digits(3), 10))
        .otherwise(_named(F.substring(piece, F.lit(2), F.length(piece))))
    )


def unicode_unescape(text: Column) -> Column:
    r"""Decode backslash escapes in text that holds ``\u``; other text never leaves the JVM."""
    hit = F.lower(text).contains("\\u")
    return F.when(hit, _unicode_unescape(F.when(hit, text))).otherwise(text)


def html_unescape(text: Column) -> Column:
    """Resolve HTML entities in text that holds ``&``."""
    pieces = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, _resolved), "")).otherwise(text)
