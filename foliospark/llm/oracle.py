"""SQL twins (DuckDB) of the queries whose whole result SQL can state; they compare everything with everything."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_WORDS = r"""list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"""

ORACLE["op1_chat"] = """
with whole as (
  select conv_id, list(struct_pack(role := role, text := text) order by turn, role, text) as turns from conversations
  where conv_id is not null group by conv_id
  union all select conv_id, [struct_pack(role := role, text := text)] from conversations where conv_id is null),
placed as (
  select *, list_max(list_filter(range(1, len(turns) + 1), lambda k: turns[k].role = 'assistant')) as k from whole),
paired as (
  select a.conv_id, a.turns as c, list_transform(range(1, len(a.turns) + 1), lambda i: struct_pack(
           role := a.turns[i].role, text := case when i = a.k then coalesce(b.turns[b.k].text, '') else a.turns[i].text end)) as r
  from placed a left join placed b on b.conv_id = xor(a.conv_id, 1)),
cut as (
  select *, len(list_filter(range(1, len(c) + 1), lambda i: c[1:i] = r[1:i])) as n from paired),
written as (
  select conv_id, n,
    list_transform(c, lambda t: concat('<|im_start|>', t.role, chr(10))) as ch, list_transform(r, lambda t: concat('<|im_start|>', t.role, chr(10))) as rh,
    list_transform(c, lambda t: concat(replace(t.text, '<|', '< |'), '<|im_end|>', chr(10))) as cb,
    list_transform(r, lambda t: concat(replace(t.text, '<|', '< |'), '<|im_end|>', chr(10))) as rb,
    list_transform(c, lambda t: t.role) as cr, list_transform(r, lambda t: t.role) as rr
  from cut),
sized as (
  select *, list_transform(range(1, len(ch) + 1), lambda i: length(ch[i]) + length(cb[i])) as cl,
    list_transform(range(1, len(rh) + 1), lambda i: length(rh[i]) + length(rb[i])) as rl from written)
select conv_id as pair_id, cast(n as integer) as n_prompt_turns,
  array_to_string(list_transform(range(1, n + 1), lambda i: concat(ch[i], cb[i])), '') as prompt,
  array_to_string(list_transform(range(n + 1, len(ch) + 1), lambda i: concat(ch[i], cb[i])), '') as chosen,
  array_to_string(list_transform(list_filter(range(n + 1, len(ch) + 1), lambda i: cr[i] = 'assistant'), lambda i: concat(
    cast(coalesce(list_sum(cl[n + 1:i - 1]), 0) as bigint) + length(ch[i]), ':', cast(list_sum(cl[n + 1:i]) as bigint))), ',') as chosen_spans,
  array_to_string(list_transform(range(n + 1, len(rh) + 1), lambda i: concat(rh[i], rb[i])), '') as rejected,
  array_to_string(list_transform(list_filter(range(n + 1, len(rh) + 1), lambda i: rr[i] = 'assistant'), lambda i: concat(
    cast(coalesce(list_sum(rl[n + 1:i - 1]), 0) as bigint) + length(rh[i]), ':', cast(list_sum(rl[n + 1:i]) as bigint))), ',') as rejected_spans
from sized
"""

# Windows are taken from pieces, so that no long text is walked through for each of its places.
ORACLE["op2_suffix_dedup"] = """
with texts as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as x from documents),
pieces as (select r, length(x) // 2 as n, p, substr(x, 400 * p + 1, 800) as part
  from texts, lateral (select unnest(range(0, length(x) // 400 + 1)) as p)),
places as (select r, 200 * p + o as i, md5_number(substr(part, 2 * o + 1, 400)) as name
  from pieces, lateral (select unnest(range(0, least(200, n - 199 - 200 * p))) as o)),
repeated as (select r, i from places qualify count(*) over (partition by name) > 1),
marked as (select r, i, i > coalesce(lag(i) over (partition by r order by i), -1000) + 200 as opens from repeated),
numbered as (select r, i, sum(opens::int) over (partition by r order by i) as k from marked),
spans as (select r, min(i) as a, max(i) + 200 as b from numbered group by r, k),
gaps as (select r, coalesce(lag(b) over (partition by r order by a), 0) as a, a as b from spans
  union all select r, max(b), null from spans group by r),
kept as (select r, coalesce(string_agg(case when gaps.b is null then substr(x, 2 * a + 1) else substr(x, 2 * a + 1, 2 * (gaps.b - a)) end, '' order by a), '') as x
  from gaps join texts using (r) group by r),
totals as (select r, sum(b - a) as removed, count(*) as n from spans group by r)
select doc_id, length(texts.x) // 2 as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed,
  cast(coalesce(n, 0) as bigint) as n_spans, sha256(unhex(coalesce(kept.x, texts.x))) as kept_sha256
from texts left join kept using (r) left join totals using (r)
"""

ORACLE["op5_minhash"] = f"""
with recursive words as (select doc_id, {_WORDS} as ws from documents),
sets as (select doc_id, list_sort(list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end)) as s from words),
nodes as (select s, min(doc_id) as node, len(s) as n from sets where len(s) > 0 group by s),
each as (select node, n, hash(unnest(s)) as shingle from nodes),
pairs as (select a.node as a, b.node as b, count(*) as common, any_value(a.n + b.n) as total
  from each a join each b on a.shingle = b.shingle and a.node < b.node group by a.node, b.node),
links as (select a, b from pairs where 100 * common >= 75 * (total - common)),
ends as (select a, b from links union all select b, a from links),
reach as (select node, node as other from nodes union select node, b from reach join ends on other = a),
groups as (select node, min(other) as component_id from reach group by node)
select doc_id, cast(len(sets.s) as bigint) as n_shingles, coalesce(component_id, doc_id) as component_id,
  coalesce(component_id, doc_id) = doc_id as kept
from sets left join nodes on sets.s = nodes.s left join groups using (node)
"""

ORACLE["op7_decontamination"] = f"""
with items as (select row_number() over () as item, item_id, ws, len(ws) as n_words, least(len(ws), 5) as k
  from (select distinct item_id, {_WORDS} as ws from benchmark) where len(ws) > 0),
grams as (select item, n_words, k, q - 1 as place, array_to_string(ws[q:q + k - 1], ' ') as gram
  from items, lateral (select unnest(range(1, n_words - k + 2)) as q)),
docs as (select row_number() over () as r, doc_id, {_WORDS} as ws from documents),
placed as (select r, k, pos - 1 as pos, len(ws) as size, array_to_string(ws[pos:pos + k - 1], ' ') as gram
  from docs, (select distinct k from items), lateral (select unnest(range(1, len(ws) - k + 2)) as pos)),
windows as (select distinct r, n_words, unnest(range(greatest(0, pos - (n_words - k)), least(pos, greatest(0, size - n_words)) + 1)) as start
  from placed join (select distinct n_words, k, gram from grams) g using (k, gram)),
inside as (select r, n_words, start, k, array_to_string(w[q:q + k - 1], ' ') as gram, len(w) - k + 1 as total
  from (select r, n_words, start, ws[start + 1:start + n_words] as w, least(n_words, 5) as k from windows join docs using (r)),
    lateral (select unnest(range(1, len(w) - k + 2)) as q)),
held as (select r, n_words, start, gram, any_value(total) as total, count(*) as n from inside group by r, n_words, start, gram),
owned as (select item, n_words, gram, count(*) as n from grams group by item, n_words, gram),
near as (select r, item, sum(least(held.n, owned.n)) as common, any_value(held.total) as total
  from held join owned using (n_words, gram) group by r, item, start),
hits as (select distinct r, item_id from near join items using (item) where 100 * common >= 75 * (total + n_words - k + 1 - common)),
told as (select r, count(*) as n, coalesce(string_agg(cast(item_id as varchar), ',' order by item_id), '') as ids from hits group by r)
select doc_id, coalesce(n, 0) as n_items, coalesce(ids, '') as item_ids, n is not null as contaminated
from docs left join told using (r)
"""

_KINDS = (
    ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, "length(v) >= 6"),
    ("access", "AKIA[A-Z0-9]+", 0, "length(v) >= 20"),
    ("hex", "[0-9a-f]+", 0, "length(v) >= 24"),
    ("random", "[A-Za-z0-9+/_=-]{24,}", 0,
     "regexp_matches(v, '[0-9]') and regexp_matches(v, '[a-z]') and regexp_matches(v, '[A-Z]')"),
)


def _found(at: int, kind: str, pattern: str, group: int, fits: str) -> str:
    """Places of a pattern's matches: what stands before them, and the matches before them, summed up."""
    return f"""
select r, {at} as kind, '{kind}' as name, a, a + length(hit) as b, v from (
  select r, v, hit, sum(length(gap) + length(hit)) over (partition by r order by k) - length(hit) as a from (
    select r, unnest(range(1, len(hits) + 1)) as k, unnest(hits) as hit, unnest(vs) as v, unnest(gaps[1:len(hits)]) as gap from (
      select r, regexp_extract_all(text, '{pattern}') as hits, regexp_extract_all(text, '{pattern}', {group}) as vs,
        regexp_split_to_array(text, '{pattern}') as gaps from docs)))
where {fits}"""


ORACLE["op6_secrets"] = f"""
with docs as (select row_number() over () as r, doc_id, source, lang, coalesce(text, '') as text from documents),
found as ({' union all '.join(_found(at, *kind) for at, kind in enumerate(_KINDS))}),
base as (select * from found where kind < 3),
more as (select * from found f where kind = 3 and not exists (select 1 from base where base.r = f.r and base.a < f.b and f.a < base.b)),
spans as (select * from base union all select * from more),
holders as (select distinct v, coalesce(source, '') as owner, source, lang from spans join docs using (r)),
often as (select v from holders group by v having count(distinct owner) >= 3 or count(*) >= 5),
judged as (select spans.*, often.v is null as live from spans left join often on spans.v = often.v),
told as (select r, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
    string_agg(concat(name, ':', cast(a as bigint), ':', cast(b as bigint)), ',' order by a, kind) filter (kind < 3) as base,
    string_agg(concat(name, ':', cast(a as bigint), ':', cast(b as bigint)), ',' order by a, kind) filter (kind < 3 or live) as spans,
    count(*) filter (live) as n_live, count(*) filter (kind < 3 and not live) as n_copied from judged group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied
from docs left join told using (r)
"""

ORACLE["op11_exact_dedup"] = r"""
with texts as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as x from documents)
select doc_id, min(doc_id) over (partition by x) as keep_id, count(*) over (partition by x) as group_size,
  row_number() over (partition by x order by doc_id nulls last) = 1 as kept, sha256(x) as text_sha256
from texts
"""

# Pairs of places with equal 16-grams, p words apart, make stretches of period p: a run agrees with itself on 16 words or more.
ORACLE["op12_periodic_runs"] = r"""
with split as (select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as ws,
    coalesce(xor(list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)), lambda crc, c:
      list_reduce(range(0, 8), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(crc, c)), 4294967295), 4294967295), 1) as h
  from documents),
chosen as (select *, h // 10 as g, len(ws) as n, h % 10 = 0 and len(ws) > 0 as odd from split),
planned as (select *, case when odd then g % n end as a from chosen),
spaced as (select *, case when odd then 1 + (n - a) // (3 + g % 8) end as p from planned),
docs as (select r, doc_id, n, case when odd then list_transform(range(0, n), lambda i: ws[1 + case when i < a then i else a + (i - a) % p end]) else ws end as ws from spaced),
words as (select r, unnest(range(0, n)) as i, unnest(ws) as w from docs),
grams as (select r, i, md5_number(string_agg(w, ' ') over (partition by r order by i rows between current row and 15 following)) as name,
    count(*) over (partition by r order by i rows between current row and 15 following) as m from words),
pairs as (select x.r, x.i, y.i - x.i as p from grams x join grams y on x.r = y.r and x.name = y.name and x.i < y.i where x.m = 16 and y.m = 16),
runs as (select r, p, min(i) as start, count(*) + 15 + p as length
  from (select *, i - row_number() over (partition by r, p order by i) as island from pairs) group by r, p, island),
found as (select r, start, length, min(p) as period from runs where length >= greatest(24, 3 * p) group by r, start, length),
dropped as (select distinct r, unnest(range(start + period, start + length)) as i from found),
best as (select * from found qualify row_number() over (partition by r order by cast(length as decimal(38, 20)) / period desc, start, period) = 1),
told as (select r, count(*) as n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' order by start, period) as written from found group by r),
kept as (select words.r, string_agg(w, ' ' order by i) as text from words anti join dropped using (r, i) group by words.r)
select doc_id, cast(coalesce(n_runs, 0) as bigint) as n_runs, cast(start as bigint) as start, cast(length as bigint) as length, cast(period as bigint) as period,
  cast(1000 * length // period as bigint) as exponent_milli, sha256(coalesce(written, '')) as runs_sha256, sha256(coalesce(kept.text, '')) as collapsed_sha256
from docs left join told using (r) left join best using (r) left join kept using (r)
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE["op13_lexical_search"] = f"""
with docs as (select row_number() over () as r, doc_id, {_TERMS} as ts from documents),
counts as (select r, t, count(*) as tf from (select r, unnest(ts) as t from docs) group by r, t),
total as (select count(*) filter (len(ts) > 0) as n_docs, cast(sum(len(ts)) as bigint) as n_terms from docs),
items as (select row_number() over () as i, item_id, list_distinct({_TERMS}) as ts from benchmark),
wanted as (select i, unnest(ts) as t from items),
holders as (select t, count(*) as df from counts group by t),
weights as (select t, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) as bigint) as w from holders, total),
sizes as (select r, doc_id, 10 + (90 * len(ts) * n_docs) // n_terms as m from docs, total where len(ts) > 0),
scores as (select i, r, any_value(doc_id) as doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from wanted join weights using (t) join counts using (t) join sizes using (r) group by i, r),
placed as (select i, row_number() over (partition by i order by score desc, doc_id nulls last) as rank, doc_id, score from scores where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from placed join items using (i) where rank <= 10
"""
