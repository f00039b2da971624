"""Column functions for comparing two texts."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetloom.functions.text import squash, token_sequence, tokens

# The error classes, in the order in which the rules are tried.
ERROR_CLASSES = [
    "match", "missing", "capitalization", "special chars", "typo", "synonym", "token subset",
    "unknown",
]

# Abbreviations of address words and what each may stand for.
ALIASES: dict[str, list[str]] = {
    "st": ["street", "saint"],
    "str": ["street", "strasse"],
    "ave": ["avenue"],
    "av": ["avenue"],
    "rd": ["road"],
    "blvd": ["boulevard"],
    "dr": ["drive"],
    "ln": ["lane"],
    "hwy": ["highway"],
    "pl": ["place"],
    "sq": ["square"],
    "ct": ["court"],
    "pkwy": ["parkway"],
    "mt": ["mount"],
    "ft": ["fort"],
    "apt": ["apartment"],
    "ste": ["suite", "sainte"],
    "n": ["north"],
    "s": ["south"],
    "e": ["east"],
    "w": ["west"],
}


def _shared(a: Column, b: Column, side) -> Column:
    """Length of the longest text both end with on ``side`` (`F.left` or `F.right`)."""
    shorter = F.least(F.length(a), F.length(b))
    return F.aggregate(
        F.array(*[F.lit(2**k) for k in range(29, -1, -1)]),
        F.lit(0),
        lambda n, step: F.when(
            (n + step <= shorter) & (side(a, n + step) == side(b, n + step)), n + step
        ).otherwise(n),
    )


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also when a lambda uses it."""
    return F.transform(F.array(value), body)[0]


def _middles(a: Column, b: Column) -> Column:
    """The two texts as an array, without what they share at their start and then at their end."""

    def cut(side, rest):
        return lambda pair: _let(
            _shared(pair[0], pair[1], side), lambda n: F.transform(pair, lambda t: rest(t, n))
        )

    rests = _let(F.array(a, b), cut(F.left, lambda t, n: F.substring(t, n + 1, F.length(t))))
    return _let(rests, cut(F.right, lambda t, n: F.left(t, F.length(t) - n)))


def _swaps(text: Column) -> Column:
    """What one exchange of neighbours near the start or the end turns the text into."""

    def swapped(i: Column) -> Column:
        return F.concat(
            F.substring(text, F.lit(1), i - 1),
            F.substring(text, i + 1, F.lit(1)),
            F.substring(text, i, F.lit(1)),
            F.substring(text, i + 2, F.length(text)),
        )

    last = F.length(text) - 1
    places = F.array(F.lit(1), F.lit(2), F.lit(3), last - 2, last - 1, last)
    return F.transform(F.filter(F.array_distinct(places), lambda i: i.between(1, last)), swapped)


def within_two_edits(left: Column, right: Column) -> Column:
    """Damerau-Levenshtein distance of at most two, without leaving the JVM.

    With L the plain Levenshtein distance and D the distance that also counts an exchange of
    neighbours as one edit, D <= L <= 2 D holds.  So L <= 2 proves D <= 2 and L > 4 disproves
    it.  For L of 3 or 4, two edits can only suffice if one of them is an exchange; as it
    comes first or last, it can be undone on one side, leaving at most one edit between.
    Without the text shared at both ends, an exchange that comes first or last lies at an end
    of what remains, so a few copies of it suffice, whatever its length.
    """
    plain = F.levenshtein(left, right, 4)

    def one_apart(a: Column, b: Column) -> Column:
        return F.levenshtein(a, b, 1) >= 0

    def exchange(ends: Column) -> Column:
        a, b = ends[0], ends[1]
        return (
            F.exists(_swaps(a), lambda s: one_apart(s, b))
            | F.exists(_swaps(b), lambda s: one_apart(a, s))
            | F.arrays_overlap(_swaps(a), _swaps(b))
        )

    found = F.exists(F.array(_middles(left, right)), exchange)
    return F.when(plain.between(0, 2), True).when(plain.between(3, 4), found).otherwise(False)


def one_edit(left: Column, right: Column) -> Column:
    """True where the texts are one edit apart, an exchange of neighbours counting as one."""
    plain = F.levenshtein(left, right, 2)
    exchanged = F.exists(
        F.array(_middles(left, right)),
        lambda m: (F.length(m[0]) == 2) & (m[0] == F.reverse(m[1])),
    )
    return F.when(plain == 2, exchanged).otherwise(plain == 1)


def edit_distance(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance of two texts."""
    start = 0
    while start < len(a) and start < len(b) and a[start] == b[start]:
        start += 1
    a, b = a[start:], b[start:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return len(a) + len(b)
    last_row: dict[str, int] = {}
    far = len(a) + len(b)
    width = len(b) + 2
    table = [[far] * width, [far, *range(len(b) + 1)]]
    for i, x in enumerate(a, 1):
        row = [far, i] + [0] * len(b)
        last_col = 0
        for j, y in enumerate(b, 1):
            k, m = last_row.get(y, 0), last_col
            cost = 0 if x == y else 1
            if not cost:
                last_col = j
            row[j + 1] = min(
                table[i][j] + cost,
                row[j] + 1,
                table[i][j + 1] + 1,
                table[k][m] + (i - k - 1) + 1 + (j - m - 1),
            )
        last_row[x] = i
        table.append(row)
    return table[-1][-1]


@F.pandas_udf(T.StringType())
def _nearest_exact(query: pd.Series, candidates: pd.Series) -> pd.Series:
    def pick(q, options):
        if q is None:
            return None
        best = nearest = None
        for option in options:
            # no distance is smaller than the difference in length
            if best is None or abs(len(q) - len(option)) < best:
                distance = edit_distance(q, option)
                if best is None or distance < best:
                    best, nearest = distance, option
        return nearest

    return pd.Series([pick(q, c) for q, c in zip(query, candidates)], dtype=object)


def _nearest(query: Column, candidates: Sequence[Column]) -> Column:
    """The candidate with the least edit distance, the first one on ties.

    D lies between half of the Levenshtein distance and the distance itself, and is never
    less than the difference in length.  Where these bounds already single out one candidate
    the answer is native; only the rows they leave open send their texts to Python.
    """
    options = F.filter(F.array(*candidates), lambda c: c.isNotNull())
    scored = F.transform(
        options,
        lambda c, i: F.struct(
            F.coalesce(F.levenshtein(query, c), F.lit(0)).alias("high"),
            i.alias("pos"),
            F.greatest(
                F.ceil(F.coalesce(F.levenshtein(query, c), F.lit(0)) / 2),
                F.abs(F.length(query) - F.length(c)),
            ).alias("low"),
            c.alias("value"),
        ),
    )
    top = F.array_min(scored)
    settled = F.forall(
        scored,
        lambda s: (s["pos"] == top["pos"])
        | (s["value"] == top["value"])
        | ((s["pos"] < top["pos"]) & (s["low"] > top["high"]))
        | ((s["pos"] > top["pos"]) & (s["low"] >= top["high"])),
    )
    open_query = F.when(~settled & query.isNotNull(), query)
    exact = _nearest_exact(open_query, F.when(open_query.isNotNull(), options))
    return (
        F.when(F.size(options) == 0, F.lit(None).cast("string"))
        .when(query.isNull(), F.get(options, F.lit(0)))
        .otherwise(F.when(settled, top["value"]).otherwise(exact))
    )


def nearest_candidate(
    query: Column, preferred: Sequence[Column], backup: Sequence[Column]
) -> Column:
    """Nearest preferred value; if that is null or empty, the nearest backup value."""
    nothing = F.lit(None).cast("string")
    first = _nearest(query, preferred) if preferred else nothing
    second = _nearest(query, backup) if backup else nothing
    return F.coalesce(F.nullif(first, F.lit("")), second)


def alias_table(aliases: Mapping[str, Sequence[str]]) -> Column:
    """The alias table as one constant map column that is parsed once, whatever its size."""
    forms = {token: [token, *words] for token, words in sorted(aliases.items())}
    return F.from_json(F.lit(json.dumps(forms)), "map<string,array<string>>")


def same_expansion(
    left: Column, right: Column, aliases: Mapping[str, Sequence[str]] = ALIASES
) -> Column:
    """True where the two texts can be written out to the same words.

    The written-out forms of a text are the product of the alternatives of its tokens; two
    such products meet exactly if they have equal length and meet at every position.
    """
    table = alias_table(aliases)

    def words(token: Column) -> Column:
        return F.coalesce(F.try_element_at(table, token), F.array(token))

    a, b = token_sequence(left), token_sequence(right)
    meets = F.zip_with(a, b, lambda x, y: F.arrays_overlap(words(x), words(y)))
    return (F.size(a) == F.size(b)) & (F.size(a) > 0) & F.forall(meets, lambda m: m)


def token_subset(left: Column, right: Column) -> Column:
    a, b = tokens(left), tokens(right)
    return (F.size(F.array_except(a, b)) == 0) | (F.size(F.array_except(b, a)) == 0)


def error_class(
    value: Column, truth: Column, aliases: Mapping[str, Sequence[str]] = ALIASES
) -> Column:
    """Error class of a dirty value against the true one; the first rule that fits wins.

    A value whose truth is null cannot be judged and is ``unknown``.
    """
    v, t = F.lower(value), F.lower(truth)
    return (
        F.when(value.eqNullSafe(truth), "match")
        .when(value.isNull(), "missing")
        .when(truth.isNull(), "unknown")
        .when(v == t, "capitalization")
        .when(squash(value) == squash(truth), "special chars")
        .when(within_two_edits(v, t), "typo")
        .when(same_expansion(v, t, aliases), "synonym")
        .when(token_subset(v, t), "token subset")
        .otherwise("unknown")
    )
