"""SQL for an independent engine, where SQL can say what an operator does.

Written from the definitions: sets and joins instead of signatures, lists instead of hashes. Operators whose
results hang on hashes (mixing), byte models, tokenizers or chunk boundaries have none; tests compare those
with brute force.
"""

from __future__ import annotations

# A-Z alone in lower case, and runs of anything but \t \n \v \f \r and space.
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x20\x09-\x0D]+"

MINHASH_DEDUP = rf"""
with recursive texts as (
  select doc_id, regexp_extract_all({LOWERED}, '{WORD}') as w from documents),
shingles as (
  select doc_id, unnest(list_distinct(case
    when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as s
  from texts),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
edges as (select a, b from links union select b, a from links),
reach as (select doc_id as a, doc_id as b from texts union select r.a, edges.b from reach r join edges on edges.a = r.b)
select t.doc_id, coalesce(n, 0) as n_shingles, c.component_id, t.doc_id = c.component_id as kept
from texts t join (select a, min(b) as component_id from reach group by a) c on c.a = t.doc_id
left join sizes s on s.doc_id = t.doc_id"""

WARC = """
with payloads as (select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as n from pages),
best as (select body, max(page_id) as target from payloads where n >= 1000 group by body)
select page_id, n as payload_bytes, sha1(p.body) as payload_digest,
  case when page_id < target then 'revisit' else 'response' end as record_type,
  case when page_id < target then target end as refers_to
from payloads p left join best b on b.body = p.body"""

# Rule number, measure, cutoffs; every rule may lose a 0.01 of the good, and there are 24 cutoffs.
QUALITY_MEASURES = [
    ("n_symbols / n_words", "[0.05, 0.1, 0.2, 0.3, 0.5, 1.0]"),
    ("n_exclaims / n_words", "[0.1, 0.2, 0.5, 1.0]"),
    ("n_dup_lines / greatest(n_lines, 1)", "[0.1, 0.2, 0.3, 0.5, 0.7]"),
    ("n_repeat_words / n_words", "[0.05, 0.1, 0.15, 0.2, 0.25]"),
    ("word_chars / n_words", "[9.0, 10.0, 12.0, 15.0]"),
]
_TRIED = "\nunion all ".join(
    f"select lang, {i} as rule, cut, ({measure}) > cut as hit from good, (select unnest({cuts}) as cut)"
    for i, (measure, cuts) in enumerate(QUALITY_MEASURES)
)
_REJECTS = " or ".join(
    f"coalesce(({measure}) > (select min(cut) from usable u where u.rule = {i} and u.lang is not distinct from m.lang), false)"
    for i, (measure, _) in enumerate(QUALITY_MEASURES)
)
QUALITY_RULES = rf"""
with texts as (
  select doc_id, lang, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{WORD}') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORD}')) as lines
  from documents),
windows as (
  select doc_id, i, array_to_string(w[i:i + 7], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) as i from texts)),
twice as (select doc_id, s from windows group by doc_id, s having count(*) > 1),
covered as (
  select doc_id, count(distinct place) as n
  from (select doc_id, unnest(range(i, i + 8)) as place from windows join twice using (doc_id, s)) group by doc_id),
measures as (
  select t.doc_id, lang, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    length(regexp_replace(text, '[^!]', '', 'g')) as n_exclaims,
    len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words,
    len(w) < 20 or 100 * coalesce(c.n, 0) > 30 * len(w) as base_failed
  from texts t left join covered c on c.doc_id = t.doc_id),
good as (
  select * from measures where not base_failed and doc_id in (select doc_id from labels where quality = 1)),
tried as ({_TRIED}),
tested as (select lang, rule, cut, count(*) as n, count(*) filter (where hit) as k from tried group by lang, rule, cut),
usable as (
  select lang, rule, cut from tested
  where k < 0.01 * n and list_sum(list_transform(range(0, k + 1), lambda i: exp(
      lgamma(n + 1.0) - (case when i = 0 then 0 else lgamma(i + 1.0) end) - lgamma(n - i + 1.0)
      + i * ln(0.01) + (n - i) * ln(0.99))))
    <= 0.05 / (24 * (select count(distinct lang) + max((lang is null)::int) from good)))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not ({_REJECTS}) as kept
from measures m"""

_MASKS = {"111010011": (0, 1, 2, 4, 7, 8), "110011101": (0, 1, 4, 5, 6, 8)}


def _under(words: str, at: str) -> str:
    """One text per mask: its number and the words under its ones."""
    texts = [
        f"'{number}' || " + " || ".join(f"' ' || {words}[{at} + {k + 1}]" for k in ones)
        for number, ones in enumerate(_MASKS.values())
    ]
    return f"unnest([{', '.join(texts)}])"


_PLAIN = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
# Best stretch: largest rise of the running sum over a lowest point before it, the first such end, the last such start.
DECONTAMINATION = f"""
with texts as (select doc_id, {_PLAIN} as w from documents),
items as (select item_id, {_PLAIN} as w from benchmark),
item_seeds as (
  select item_id, w, q, {_under("w", "q")} as seed
  from (select item_id, w, unnest(range(0, greatest(len(w) - 8, 0))) as q from items)),
text_places as (select doc_id, unnest(range(0, greatest(len(w) - 8, 0))) as p, w from texts),
text_seeds as (select doc_id, p, {_under("w", "p")} as seed from text_places),
diagonals as (
  select distinct t.doc_id, i.item_id, i.w as item, cast(t.p as bigint) - i.q as d
  from text_seeds t join item_seeds i on i.seed = t.seed),
steps as (
  select *, sum(case when w[d + k + 1] = item[k + 1] then 1 else -1 end) over (partition by doc_id, item_id, d order by k) as upto
  from (select g.*, t.w, unnest(range(greatest(-d, 0), least(len(t.w) - d, len(item)))) as k
        from diagonals g join texts t on t.doc_id = g.doc_id)),
lows as (
  select *, coalesce(min(upto) over (partition by doc_id, item_id, d order by k
      rows between unbounded preceding and 1 preceding), 0) as low_before,
    min(k) over (partition by doc_id, item_id, d) as first_k
  from steps),
ends as (
  select *, upto - least(low_before, 0) as score from lows),
best as (
  select * from ends qualify row_number() over (partition by doc_id, item_id, d order by score desc, k) = 1),
starts as (
  select b.doc_id, b.item_id, b.d, any_value(len(b.item)) as size, any_value(b.score) as score, any_value(b.k) + 1 as stop,
    coalesce(max(s.k) filter (where s.k < b.k and s.upto = least(b.low_before, 0)) + 1, any_value(b.first_k)) as start
  from best b join steps s on s.doc_id = b.doc_id and s.item_id = b.item_id and s.d = b.d
  group by 1, 2, 3),
short as (select item_id, len(w) as n, array_to_string(w, ' ') as s from items where len(w) between 1 and 8),
short_places as (
  select doc_id, n, w, unnest(range(0, greatest(len(w) - n + 1, 0))) as p from texts, (select distinct n from short)),
found as (
  select doc_id, item_id, cast(score as int) as score, cast((score + stop - start) // 2 as int) as equal_words,
    cast(stop - start as int) as words, cast(d + start as int) as position
  from starts where score >= least(10, size // 2)
  union all
  select doc_id, item_id, cast(n as int), cast(n as int), cast(n as int), cast(p as int)
  from (select doc_id, n, p, array_to_string(w[p + 1:p + n], ' ') as s from short_places) join short using (n, s))
select * from found qualify row_number() over (
  partition by doc_id, item_id order by score desc, equal_words desc, words desc, position) = 1"""

def _framed(value: str) -> str:
    return f"coalesce(strlen(cast({value} as varchar)) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_framed(v) for v in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


# CRC-32 of a decimal number, bit by bit.
_BIT = "if(c % 2 = 1, xor(c >> 1, 3988292384), c >> 1)"
_BYTE = "list_reduce(range(0, 8), lambda c, i: " + _BIT + ", xor(s, cast(ord(digit) as bigint)))"
_CRC = (
    "xor(list_reduce(string_split(cast(doc_id as varchar), ''), lambda s, digit: "
    + _BYTE
    + ", cast(4294967295 as bigint)), 4294967295)"
)


def _tree(name: str, leaves: str) -> str:
    """Nodes (grp, level, pos, n, h) of all levels over leaves (grp, pos, n, h)."""
    return f"""{name} as (
  select grp, 0 as level, pos, n, h from {leaves}
  union all
  select grp, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' order by pos)) from {name} where n > 1
  group by grp, level, n, pos // 2)"""


def _path(tree: str, leaves: str) -> str:
    """Per leaf its siblings upwards: left sibling's digest, right sibling's, both '' where there is none."""
    return f"""select l.grp, l.pos,
    coalesce(list({{'a': coalesce(a.h, ''), 'b': coalesce(b.h, '')}} order by t.level) filter (where t.n > 1), []) as path
  from {leaves} l join {tree} t on t.grp = l.grp and t.pos = l.pos >> t.level
  left join {tree} a on a.grp = t.grp and a.level = t.level and a.pos = t.pos - 1 and t.pos % 2 = 1
  left join {tree} b on b.grp = t.grp and b.level = t.level and b.pos = t.pos + 1 and t.pos % 2 = 0
  group by l.grp, l.pos"""


MERKLE_MANIFEST = f"""
with recursive rows as (
  select doc_id, coalesce('=' || lang, '-') as grp, {_leaf("n_chars")} as h,
    if({_CRC} % 7 = 0, {_leaf("coalesce(n_chars + 1, n_chars)")}, {_leaf("n_chars")}) as tampered
  from documents),
leaves as (
  select *, row_number() over (partition by grp order by doc_id nulls first, h) - 1 as pos,
    count(*) over (partition by grp) as n from rows),
{_tree("tree", "leaves")},
subroots as (
  select grp as lang_key, '' as grp, row_number() over (order by grp) - 1 as pos, count(*) over () as n, h
  from tree where n = 1),
{_tree("top", "subroots")},
paths as ({_path("tree", "leaves")}),
upper_paths as ({_path("top", "subroots")}),
proven as (
  select l.doc_id, l.h as leaf, s.h as subroot, (select h from top where n = 1) as root, l.tampered, p.path || u.path as path
  from leaves l join paths p on p.grp = l.grp and p.pos = l.pos
  join subroots s on s.lang_key = l.grp join upper_paths u on u.pos = s.pos),
folded as (
  select * exclude (path, tampered), sha256(array_to_string(list_transform(path, lambda x: x.a || x.b), '')) as proof_sha256,
    list_reduce(list_transform(path, lambda x: [x.a, x.b]), lambda node, x: [sha256(x[1] || node[1] || x[2])], [tampered])[1]
      as folded_root
  from proven)
select *, folded_root = root as verified from folded"""

_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LINE_DEDUP = f"""
with texts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
places as (select doc_id, unnest(lines) as line, unnest(range(0, len(lines))) as place from texts),
keyed as (select *, {_KEY} as key from places),
firsts as (select key, min(doc_id) as first from keyed where length(key) >= 10 group by key),
marked as (select k.*, coalesce(k.doc_id > f.first, false) as dropped from keyed k left join firsts f using (key))
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id"""

SQL: dict[str, str] = {
    "op1_minhash_dedup": MINHASH_DEDUP,
    "op2_warc": WARC,
    "op4_quality_rules": QUALITY_RULES,
    "op8_decontamination": DECONTAMINATION,
    "op12_merkle_manifest": MERKLE_MANIFEST,
    "op13_line_dedup": LINE_DEDUP,
}
