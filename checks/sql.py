"""Pieces of DuckDB SQL shared by the oracles."""

from __future__ import annotations

from checks.fixtures import COLUMNS

# The oracles' own lists, so that a change of the library's is noticed.
ERROR_CLASSES = [
    "match", "missing", "capitalization", "special chars", "typo", "synonym", "token subset", "unknown",
]
ALIASES = {
    "st": ["street", "saint"], "str": ["street", "strasse"], "ave": ["avenue"], "av": ["avenue"],
    "rd": ["road"], "blvd": ["boulevard"], "dr": ["drive"], "ln": ["lane"], "hwy": ["highway"],
    "pl": ["place"], "sq": ["square"], "ct": ["court"], "pkwy": ["parkway"], "mt": ["mount"],
    "ft": ["fort"], "apt": ["apartment"], "ste": ["suite", "sainte"],
    "n": ["north"], "s": ["south"], "e": ["east"], "w": ["west"],
}


def squash(x: str) -> str:
    return rf"lower(regexp_replace({x}, '[^\p{{L}}\p{{N}}]+', '', 'g'))"


def sequence(x: str) -> str:
    spaced = rf"regexp_replace({x}, '[^\p{{L}}\p{{N}}]+', ' ', 'g')"
    return f"list_filter(string_split({spaced}, ' '), lambda w: w <> '')"


def _map() -> str:
    def words(token, forms):
        return "[" + ", ".join(f"'{w}'" for w in [token, *forms]) + "]"

    return "map {" + ", ".join(f"'{t}': {words(t, f)}" for t, f in ALIASES.items()) + "}"


def forms(x: str) -> str:
    """All written-out forms of a text, as texts."""
    table = _map()
    return (
        f"list_reduce(list_transform({sequence(x)}, lambda w: coalesce({table}[w], [w])), "
        f"lambda a, b: flatten(list_transform(a, lambda p: list_transform(b, lambda q: p || ' ' || q))), [''])"
    )


def subset(a: str, b: str) -> str:
    return f"(list_has_all({sequence(a)}, {sequence(b)}) or list_has_all({sequence(b)}, {sequence(a)}))"


def error_class(v: str, t: str) -> str:
    return f"""case when {v} is not distinct from {t} then 'match'
 when {v} is null then 'missing'
 when {t} is null then 'unknown'
 when lower({v}) = lower({t}) then 'capitalization'
 when {squash(v)} = {squash(t)} then 'special chars'
 when damerau_levenshtein(lower({v}), lower({t})) <= 2 then 'typo'
 when list_has_any({forms(f'lower({v})')}, {forms(f'lower({t})')}) then 'synonym'
 when {subset(f'lower({v})', f'lower({t})')} then 'token subset'
 else 'unknown' end"""


def cells(value: str = "d2", truth: str = "d1") -> str:
    return " union all ".join(
        f"select v.row_id, '{c}' as column_name, v.{c} as value, t.{c} as truth "
        f"from {value} v join {truth} t on v.row_id = t.row_id"
        for c in COLUMNS
    )


CLASSED = f"select row_id, column_name, value, truth, {error_class('value', 'truth')} as errortype from cells"
CLASSES = ERROR_CLASSES


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def title(x: str) -> str:
    runs = rf"regexp_extract_all(lower({x}), '\p{{L}}+|\P{{L}}+')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || r[2:]), '')"


_NUMBER = r"\d+\p{L}?(?:\s*[-/]\s*\d+\p{L}?)?"
_RULES = [
    (rf"^\s*(\S.*?)\s*,\s*({_NUMBER})\s*$", 1, 2),
    (rf"^\s*(.*\p{{L}}.*?)\s+({_NUMBER})\s*$", 1, 2),
    (rf"^\s*({_NUMBER})[\s,]+(\S.*?)\s*$", 2, 1),
]


def road(x: str) -> str:
    cases = " ".join(
        f"when regexp_matches({x}, '{p}') then regexp_extract({x}, '{p}', {r})" for p, r, _ in _RULES
    )
    whole = strip(x)
    return title(f"nullif(case {cases} else {whole} end, '')")


def house(x: str) -> str:
    cases = " ".join(
        f"when regexp_matches({x}, '{p}') then regexp_extract({x}, '{p}', {h})" for p, _, h in _RULES
    )
    return title(f"case {cases} end")


def match_text(x: str) -> str:
    return rf"nullif(trim(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), '')"


def country_code(x: str) -> str:
    return f"case when regexp_matches({x}, '^[A-Za-z]{{2}}$') then lower({x}) end"
