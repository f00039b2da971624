"""Column functions for JSON-LD: scripts in a page, strict parsing, walking a value tree.

A parsed document is a ``variant`` column.  Trees are walked level by level with the
``aggregate`` function inside one narrow stage: a few rounds for the usual documents, and for
deeper ones as many as there are opening brackets in the text, so any depth is covered.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetloom.functions.markup import TolerantParser

JSON_LD_TYPE = "application/ld+json"

# A page scanner steps over comments, tags with their attribute values, and raw text as a
# whole, and stops at scripts.  Possessive quantifiers keep the matcher from back-tracking
# over large pages; an end of the page counts as a (blank) stop, so the rest is read once.
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)*+"""
_OPEN_SCRIPT = rf"<script(?=[\s/>]){_ATTRIBUTES}>"
_RAW_TEXT = "|".join(
    rf"<{tag}(?=[\s/>]){_ATTRIBUTES}>.*?(?:</{tag}(?=[\s/>])|\z)"
    for tag in ("style", "textarea", "title")
)
_REGIONS = (
    rf"(?is)(?:[^<]++|<!--(?:-?>|.*?(?:-->|\z))|{_RAW_TEXT}"
    rf"|(?!{_OPEN_SCRIPT})</?[a-z]{_ATTRIBUTES}(?:>|\z)|<(?!/?[a-z]))*+"
    rf"({_OPEN_SCRIPT}.*?(?:</script(?=[\s/>])|\z)|\z)"
)
_OPEN_TAG = rf"(?is)^<script({_ATTRIBUTES})>"
_BODY = rf"(?is)^<script{_ATTRIBUTES}>(.*?)(?:</script)?\z"
_ATTRIBUTE = r"""([^\s=>"'/]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
_PLUS_ENTITY = "&#(?:43|[xX]2[bB]);"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def script_texts(page: Column) -> Column:
    """Texts of all JSON-LD scripts of a page, in page order, empty ones left out."""
    clean = F.replace(page, F.lit("\0"), F.lit(""))
    regions = F.regexp_extract_all(clean, F.lit(_REGIONS), F.lit(1))

    def script_type(region: Column) -> Column:
        """Value of the first ``type`` attribute."""
        attributes = F.regexp_extract(region, _OPEN_TAG, 1)
        names = F.regexp_extract_all(F.lower(attributes), F.lit(_ATTRIBUTE), F.lit(1))
        values = F.regexp_extract_all(attributes, F.lit(_ATTRIBUTE), F.lit(2))
        value = F.get(values, F.array_position(names, "type").cast("int") - 1)
        return F.regexp_replace(F.regexp_replace(value, "^[\"']|[\"']$", ""), _PLUS_ENTITY, "+")

    def is_json_ld(region: Column) -> Column:
        return F.coalesce(script_type(region) == JSON_LD_TYPE, F.lit(False))

    bodies = F.transform(
        F.filter(regions, is_json_ld), lambda region: F.regexp_extract(region, _BODY, 1)
    )
    return F.filter(bodies, lambda text: text != "")


class _ScriptCollector(TolerantParser):
    CDATA_CONTENT_ELEMENTS = ("script", "style", "textarea", "title")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts, self.inside = [], False

    def handle_starttag(self, tag, attrs):
        self.inside = tag == "script" and dict(reversed(attrs)).get("type") == JSON_LD_TYPE

    def handle_endtag(self, tag):
        self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.texts.append(data)


@F.pandas_udf(T.ArrayType(T.StringType()))
def script_texts_parsed(page: pd.Series) -> pd.Series:
    """The same texts found by an HTML parser; slower, for pages with unusual markup."""

    def collect(text):
        if text is None:
            return None
        parser = _ScriptCollector()
        parser.feed(text.replace("\0", ""))
        parser.close()
        return parser.texts

    return page.map(collect)


def _parse_wrapped(text: Column) -> Column:
    """Parse exactly one JSON value, or null.

    Spark's parser stops after the first complete value and ignores what follows.  Put the
    text into an array in front of a mark derived from the text itself: only if the text is
    one whole value does the array have two elements, the second being the mark.
    """
    mark = F.xxhash64(text).cast("string")
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))

    def only_item(items: Column) -> Column:
        whole = (F.size(items) == 2) & (F.try_variant_get(items[1], "$", "string") == mark)
        return F.when(whole, items[0])

    return _let(F.try_variant_get(wrapped, "$", "array<variant>"), only_item)


def parse_json(text: Column) -> Column:
    """One JSON document as a variant; null where the text is not exactly one document.

    The number words NaN, Infinity and -Infinity, which JSON writers of scripting languages
    emit, are accepted as the texts ``nan``, ``inf`` and ``-inf``.
    """
    pieces = F.regexp_extract_all(text, F.lit(r'"(?:[^"\\]++|\\.)*+"|[^"]++|"'), F.lit(0))
    worded = F.array_join(
        F.transform(
            pieces,
            lambda p: F.when(p.startswith('"'), p).otherwise(
                F.regexp_replace(
                    F.regexp_replace(
                        F.regexp_replace(p, r"(?<![\w-])NaN\b", '"nan"'),
                        r"-Infinity\b",
                        '"-inf"',
                    ),
                    r"(?<![\w-])Infinity\b",
                    '"inf"',
                )
            ),
        ),
        "",
    )
    return _let(
        _parse_wrapped(text),
        lambda plain: F.when(plain.isNotNull(), plain).when(
            text.rlike("NaN|Infinity"), _parse_wrapped(worded)
        ),
    )


def is_json(text: Column) -> Column:
    """True for text that is one JSON document; looks at the first character before parsing."""
    starts = text.rlike(r'^[ \t\r\n]*["\[{\d\-tfnNI]')
    return F.when(starts, parse_json(text).isNotNull()).otherwise(F.lit(False))


def as_array(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def as_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


_USUAL_DEPTH = 12


def _walk(
    value: Column,
    start: Column,
    step: Callable[[Column, Column], Column],
    unfinished: Callable[[Column], Column],
) -> Column:
    """Apply ``step`` level by level until nothing is left to open."""

    def go_on(state: Column) -> Column:
        openers = F.length(F.regexp_replace(F.to_json(value), r"[^{\[]+", ""))
        rounds = F.sequence(F.lit(1), F.greatest(openers, F.lit(1)))
        return F.when(unfinished(state), F.aggregate(rounds, state, step)).otherwise(state)

    usual = F.array(*[F.lit(i) for i in range(_USUAL_DEPTH)])
    return _let(F.aggregate(usual, start, step), go_on)


def sub_objects(value: Column, condition: Callable[[Column], Column] | None = None) -> Column:
    """All objects of a value tree, the root included, through objects and arrays.

    ``condition`` keeps only the objects it is true for and runs before anything is exploded.
    """

    def opened(nodes: Column) -> Column:
        """The lists and objects among the nodes, with what they hold."""
        held = F.transform(
            nodes,
            lambda n: F.struct(
                n.alias("node"), as_array(n).alias("items"), as_object(n).alias("members")
            ),
        )
        return F.filter(held, lambda h: h["items"].isNotNull() | h["members"].isNotNull())

    def step(acc: Column, _: Column) -> Column:
        front = acc["front"]
        below = F.flatten(
            F.transform(front, lambda h: F.coalesce(h["items"], F.map_values(h["members"])))
        )
        objects = F.transform(
            F.filter(front, lambda h: h["members"].isNotNull()), lambda h: h["node"]
        )
        return F.when(F.size(front) == 0, acc).otherwise(
            F.struct(opened(below).alias("front"), F.concat(acc["seen"], objects).alias("seen"))
        )

    start = F.struct(
        opened(F.array(value)).alias("front"), F.array().cast("array<variant>").alias("seen")
    )
    found = _walk(value, start, step, lambda acc: F.size(acc["front"]) > 0)["seen"]
    return found if condition is None else F.filter(found, condition)


def has_postal_address(node: Column) -> Column:
    """The object's ``address`` is an object whose ``@type`` is exactly PostalAddress."""
    kind = F.try_variant_get(node, '$.address["@type"]', "string")
    return F.coalesce(kind == "PostalAddress", F.lit(False))


def field(node: Column, path: str) -> Column:
    return F.try_variant_get(node, path, "variant")


def is_falsy(value: Column) -> Column:
    """Missing, null, empty text, zero, false, empty list or empty object."""
    return value.isNull() | F.to_json(value).isin("null", '""', "0", "0.0", "-0.0", "false", "[]", "{}")


def _scalar_text(value: Column, blank_as_null: bool) -> Column:
    number = F.try_variant_get(value, "$", "double")

    def written(seen: Column) -> Column:
        kind, text = seen["kind"], seen["text"]
        decimal = kind.startswith("DECIMAL")
        digits = F.length(F.regexp_replace(text, r"\D", ""))
        return (
            F.when(kind == "STRING", F.when(~text.rlike(r"^\s*$"), text) if blank_as_null else text)
            .when(kind == "BIGINT", text)
            .when(kind == "BOOLEAN", F.initcap(text))
            # integers are BIGINT up to 18 digits, so this decimal was written as 5.0
            .when(decimal & ~text.contains(".") & (digits <= 18), F.concat(text, F.lit(".0")))
            .when(decimal & text.contains(".") & (digits > 15), number.cast("string"))
            .when(
                (kind == "DOUBLE") & (F.abs(number) < 1e16) & (number == F.floor(number)),
                F.concat(number.cast("decimal(20,0)").cast("string"), F.lit(".0")),
            )
            .when(~kind.startswith("OBJECT") & ~kind.startswith("ARRAY"), text)
        )

    seen = F.struct(
        F.schema_of_variant(value).alias("kind"),
        F.try_variant_get(value, "$", "string").alias("text"),
    )
    return _let(seen, written)


def value_text(value: Column, blank_as_null: bool = False) -> Column:
    """Text of a dynamic value.

    Text stays, numbers and booleans are written out, an object stands for its ``name``, a
    list for its non-empty parts joined by ``", "`` (an empty list is the empty text).
    """

    def nested(node: Column) -> Column:
        return as_array(node).isNotNull() | as_object(node).isNotNull()

    def opened(node: Column) -> Column:
        return F.coalesce(
            as_array(node),
            F.when(as_object(node).isNotNull(), F.array(field(node, "$.name"))),
            F.array(node),
        )

    def unfinished(acc: Column) -> Column:
        return F.exists(acc["front"], lambda n: F.coalesce(nested(n), F.lit(False)))

    def step(acc: Column, _: Column) -> Column:
        lists = acc["list"] | F.exists(
            acc["front"], lambda n: F.coalesce(as_array(n).isNotNull(), F.lit(False))
        )
        return F.when(~unfinished(acc), acc).otherwise(
            F.struct(
                F.flatten(F.transform(acc["front"], opened)).alias("front"),
                F.coalesce(lists, F.lit(False)).alias("list"),
            )
        )

    def finish(acc: Column) -> Column:
        parts = F.transform(acc["front"], lambda n: _scalar_text(n, blank_as_null))
        joined = F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), ", ")
        return F.when(acc["list"], joined).otherwise(F.get(parts, F.lit(0)))

    start = F.struct(F.array(value).alias("front"), F.lit(False).alias("list"))
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(
            F.schema_of_variant(value) == "STRING",
            F.when(~text.rlike(r"^\s*$"), text) if blank_as_null else text,
        )
        .when(nested(value), _let(_walk(value, start, step, unfinished), finish))
        .otherwise(_scalar_text(value, blank_as_null))
    )


def value_texts(values: dict[str, Column], blank_as_null: bool = False) -> Column:
    """struct of the texts of several dynamic values; the rules appear in the plan only once."""
    texts = F.transform(
        F.array(*values.values()), lambda value: value_text(value, blank_as_null)
    )
    return _let(
        texts,
        lambda t: F.struct(*[F.get(t, F.lit(i)).alias(name) for i, name in enumerate(values)]),
    )
