"""The same results as DuckDB SQL over the same tables."""

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Ratio: top, bottom, two sides, room beside the median.
_RATIOS = [
    ("word_length", "word_chars", "n_words", True, 30000),
    ("symbols", "n_symbols", "n_words", False, 1000),
    ("dup_lines", "n_dup_lines", "n_lines", False, 3000),
    ("repeats", "n_repeat_words", "n_words", False, 1250),
]


def _cell(value: str) -> str:
    return f"({value}) - ({value}) % (1::bigint << greatest(length(bin({value})) - 5, 0))"


def _quartiles(name: str, source: str, keys: str) -> str:
    by = f"{keys}, ratio" if keys else "ratio"
    lead = f"{keys}, " if keys else ""
    return f"""
{name}_cells as (select {lead}ratio, cell, sum(n)::bigint n from {source} group by {by}, cell),
{name}_cum as (select *, sum(n) over (partition by {by} order by cell) upto, sum(n) over (partition by {by}) total
  from {name}_cells),
{name} as (select {lead}ratio, max(total) size, min(case when 4 * upto >= total then cell end) q1,
  min(case when 4 * upto >= 2 * total then cell end) q2, min(case when 4 * upto >= 3 * total then cell end) q3
  from {name}_cum group by {by})"""


def _fits() -> str:
    tests = []
    for name, top, bottom, both, _ in _RATIOS:
        value = _cell(f"{top} * 10000 // nullif({bottom}, 0)")
        tests.append(f"coalesce({value} <= {name}_high, true)")
        if both:
            tests.append(f"coalesce({value} >= {name}_low, true)")
    return " and ".join(tests)


def _limits() -> str:
    out = []
    for name, _, _, both, room in _RATIOS:
        here = f"case when ratio = '{name}' then"
        out.append(f"max({here} greatest(q3 + 3 * (q3 - q1), q2 + {room}) end) {name}_high")
        if both:
            out.append(f"max({here} least(q1 - 3 * (q3 - q1), q2 - {room}) end) {name}_low")
    return ", ".join(out)


_CELLS = " union all ".join(
    f"select lang, source, '{name}' ratio, {_cell(f'{top} * 10000 // {bottom}')} cell from measured "
    "where not base_failed and n_lines > 0"
    for name, top, bottom, _, _ in _RATIOS
)

QUALITY = rf"""
with w as (select row_number() over () rid, doc_id, lang, source, coalesce(text, '') t, {_WORDS} ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls
  from documents),
toks as (select rid, unnest(ws) d, unnest(range(1, len(ws) + 1)) i from w),
spots as (select rid, i, d || ' ' || lead(d) over v || ' ' || lead(d, 2) over v || ' ' || lead(d, 3) over v || ' ' ||
  lead(d, 4) over v k from toks window v as (partition by rid order by i)),
keyed as (select rid, i, count(*) over (partition by rid, k) c from spots where k is not null),
steps as (select rid, least(5, i - coalesce(lag(i) over (partition by rid order by i), -5)) s from keyed where c > 1),
repeats as (select rid, sum(s)::bigint n from steps group by rid),
measured as (select w.rid, doc_id, lang, source, len(ws)::bigint n_words,
  length(array_to_string(ws, ''))::bigint word_chars,
  (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint n_symbols,
  (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines, coalesce(n, 0)::bigint n_repeat_words,
  len(ls)::bigint n_lines, (len(ws) < 10 or 100 * coalesce(n, 0) > 20 * len(ws)) base_failed
  from w left join repeats on w.rid = repeats.rid),
cells as (select lang, source, ratio, cell, count(*) n from ({_CELLS}) group by all),
{_quartiles("own", "cells", "lang, source")},
{_quartiles("by_lang", "cells", "lang")},
{_quartiles("by_all", "cells", "")},
used as (select o.lang, o.source, o.ratio, unnest(case when o.size >= 100 then {{q1: o.q1, q2: o.q2, q3: o.q3}}
  when l.size >= 100 then {{q1: l.q1, q2: l.q2, q3: l.q3}} else {{q1: a.q1, q2: a.q2, q3: a.q3}} end)
  from own o join by_lang l on o.lang is not distinct from l.lang and o.ratio = l.ratio
  join by_all a on o.ratio = a.ratio),
limits as (select lang, source, {_limits()} from used group by lang, source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {_fits()} kept
from measured m left join limits l on m.lang is not distinct from l.lang and m.source is not distinct from l.source
"""

LINE_DEDUP = r"""
with docs as (select row_number() over (order by doc_id) rid, doc_id, text, string_split(text, chr(10)) ls from documents),
lines as (select rid, p, ls[p] line, len(list_filter(string_split_regex(ls[p], '[\x20\x09-\x0D]+'), lambda x: x <> '')) w
  from (select rid, ls, unnest(range(1, len(ls) + 1)) p from docs)),
seqs as (select rid, p, line, w, row_number() over (partition by rid order by p) i,
  sum(w) over (partition by rid order by p) upto from lines where w > 0),
ahead as (select a.rid, a.i first, min(b.i) last from seqs a join seqs b on a.rid = b.rid and b.i between a.i and a.i + 49
  where b.upto - a.upto + a.w >= 50 group by a.rid, a.i),
back as (select a.rid, max(b.i) first, a.i last from seqs a join seqs b on a.rid = b.rid and b.i between a.i - 49 and a.i
  where a.upto - b.upto + b.w >= 50 group by a.rid, a.i),
runs as (select * from ahead union select * from back),
texts as (select r.rid, r.first, r.last, string_agg(s.line, chr(10) order by s.i) body
  from runs r join seqs s on r.rid = s.rid and s.i between r.first and r.last group by r.rid, r.first, r.last),
copies as (select *, row_number() over (partition by body order by rid, first) k from texts),
gone as (select distinct s.rid, s.p from copies c join seqs s on c.rid = s.rid and s.i between c.first and c.last where k > 1),
kept as (select rid, count(g.p)::bigint n_deleted, string_agg(case when g.p is null then line end, chr(10) order by p) body
  from lines left join gone g using (rid, p) group by rid)
select doc_id, coalesce(n_deleted, 0) n_deleted, case when text is not null then coalesce(body, '') end as text
from docs left join kept using (rid)
"""


def _found(kind: str, order: int, pattern: str, group: int, least: int, flags: str) -> str:
    """Spans of one kind: the pieces between matches give the places."""
    return f"""
select rid, '{kind}' kind, {order} o, start, start + length(m) stop from (
  select rid, m, v, (sum(length(b)) over w + sum(length(m)) over w - length(m))::bigint start from (
    select rid, unnest(regexp_extract_all(t, {pattern}, 0{flags})) m,
      unnest(regexp_extract_all(t, {pattern}, {group}{flags})) v,
      unnest(string_split_regex(t, {pattern}{flags})[:-2]) b,
      unnest(range(len(regexp_extract_all(t, {pattern}, 0{flags})))) k
    from d where regexp_matches(t, {pattern}{flags}))
  window w as (partition by rid order by k)) where length(v) >= {least}"""


_ASSIGN = r"""'(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""
_SPANS = " union all ".join(
    [
        _found("assign", 0, _ASSIGN, 2, 8, ", 'i'"),
        _found("access", 1, "'AKIA[A-Z0-9]+'", 0, 16, ""),
        _found("hex", 2, "'[0-9a-f]+'", 0, 32, ""),
        _found("pem", 3, "'-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----'", 0, 1, ""),
    ]
)

SECRETS = f"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') t from documents),
spans as ({_SPANS}),
lists as (select rid, count(*) filter (kind = 'assign') n_assign, count(*) filter (kind = 'access') n_access,
  count(*) filter (kind = 'hex') n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' order by start, o) s,
  string_agg(kind || ':' || start || ':' || stop, ',' order by start, o) filter (o < 3) base
  from spans group by rid)
select doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex,
  sha256(coalesce(base, '')) base_sha256, coalesce(s, '') spans
from d left join lists using (rid)
"""

_UNITS = r"regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+')"
_DRAWS = ", ".join(f"('0x' || substr(s, {1 + 8 * i}, 8))::bigint h{i + 1}" for i in range(4))

FILL_IN_MIDDLE = f"""
with texts as (select doc_id, coalesce(text, '') t, sha256('42:' || coalesce(doc_id::varchar, '')) s from documents),
units as (select *, {_UNITS} u, {_DRAWS} from texts),
drawn as (select *, len(u) n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) a,
  greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) b from units),
cut as (select doc_id, n, t, array_to_string(u[1 : a], '') p, array_to_string(u[a + 1 : b], '') m,
  array_to_string(u[b + 1 : n], '') q,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain'
    when h4 % 100 < 80 then 'spm' else 'psm' end form from drawn)
select doc_id, n::bigint n, form, case when form <> 'plain' then length(p) end prefix_chars,
  case when form <> 'plain' then length(m) end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || q || '<M>' || m
    else '<S>' || q || '<P>' || p || '<M>' || m end) output_sha256, sha256(t) restored_sha256
from cut
"""


def _leaf(text: str) -> str:
    values = ["doc_id", "source", "lang", "n_chars", text]
    fields = [f"coalesce(strlen({v}::varchar) || ':' || {v}::varchar, '-')" for v in values]
    return f"sha256({' || '.join(fields)})"


def _nodes(name: str, leaves: str) -> str:
    return f"""
{name} as (select tree, 0 as level, idx, size, digest from {leaves}
  union all
  select tree, level + 1, idx // 8, (size + 7) // 8, sha256(string_agg(digest, '' order by idx))
  from {name} where size > 1 group by tree, level, idx // 8, size)"""


def _paths(name: str, leaves: str, nodes: str) -> str:
    own = "l.idx // (8 ** n.level)::bigint"
    return f"""
{name} as (select l.tree, l.idx, n.level, [coalesce(string_agg(n.digest, '' order by n.idx) filter (n.idx < {own}), ''),
    coalesce(string_agg(n.digest, '' order by n.idx) filter (n.idx > {own}), '')] sides
  from {leaves} l join {nodes} n on l.tree = n.tree and n.size > 1 and n.idx // 8 = {own} // 8
  group by l.tree, l.idx, n.level)"""


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
  range(1, length(doc_id::varchar) + 1), lambda i: [ascii(substr(doc_id::varchar, i, 1))::bigint, 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, x: case when xor(c, x) & 1 = 1 then xor(xor(c, x) >> 1, 3988292384) else xor(c, x) >> 1 end), 4294967295::bigint)"""

MERKLE_MANIFEST = f"""
with recursive docs as (select doc_id, coalesce('=' || lang, '-') tree, {_leaf('text')} digest,
  case when {_CRC32} % 3 = 0 then {_leaf(_LOWERED)} end forged from documents),
leaves as (select *, row_number() over (partition by tree order by doc_id nulls first, digest) - 1 as idx,
  count(*) over (partition by tree) size from docs),
{_nodes('nodes', 'leaves')},
tops as (select '' as tree, row_number() over (order by tree) - 1 as idx, count(*) over () size, digest, tree as of_tree
  from nodes where size = 1),
{_nodes('upper_nodes', 'tops')},
root as (select digest as root from upper_nodes where size = 1),
{_paths('low', 'leaves', 'nodes')},
{_paths('high', 'tops', 'upper_nodes')},
steps as (select tree, idx, level, sides from low
  union all select l.tree, l.idx, 100 + h.level, h.sides from leaves l join tops t on t.of_tree = l.tree
    join high h on h.idx = t.idx),
proofs as (select tree, idx, list(sides order by level) path from steps group by tree, idx),
folded as (select l.doc_id, l.digest leaf, t.digest subroot, root,
  sha256(array_to_string(list_transform(coalesce(path, []), lambda s: s[1] || s[2]), '')) proof_sha256,
  list_reduce(list_prepend([coalesce(forged, l.digest), ''], coalesce(path, [])),
    lambda a, s: [sha256(s[1] || a[1] || s[2]), ''])[1] folded_root
  from leaves l join tops t on t.of_tree = l.tree cross join root left join proofs p on p.tree = l.tree and p.idx = l.idx)
select *, folded_root = root verified from folded
"""
