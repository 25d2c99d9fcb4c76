"""SQL counterparts of the registered pipeline operators that SQL can express."""

from __future__ import annotations

from tallyloom.llm.line_dedup import MIN_SITES

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"'[^\x20\x09-\x0D]+'"
_UNIT = r"'[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_MIX = rf"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), {_WORD})) as bigint) as size,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '/' || coalesce(text, '')), 1, 9) as bigint) as h
  from documents),
s as (
  select source, cast(sum(size) as bigint) as ss,
         [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w
  from d group by source),
p as (
  select *, sum(ss) over () as total,
         coalesce(sum(ss) over (order by ss / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as capped,
         sum(w) over (order by ss / w, source nulls last rows between current row and unbounded following) as free
  from s),
level as (
  select 3 * total - 4 * capped as num, 2 * free as den from p
  where w * (3 * total - 4 * capped) <= 4 * free * ss order by capped, free desc limit 1),
t as (
  select source, ss, case when w * num > 2 * den * ss then cast(2 * ss as double)
                          else cast(w as double) * cast(num as double) / cast(den as double) end as target
  from s, level),
c as (select *, case when ss = 0 then 0 else cast(floor(target / ss) as bigint) end as copies from t),
u as (
  select source, h, n, sum(n) over (partition by source order by h) as upto
  from (select source, h, sum(size) as n from d group by source, h))
select d.doc_id, d.size, c.ss as source_size, c.target,
       cast(d.size * (c.copies + case when 2 * u.upto - u.n <= 2 * (c.target - c.copies * c.ss) then 1 else 0 end) as bigint) as taken
from d join c on d.source is not distinct from c.source
     join u on d.source is not distinct from u.source and d.h = u.h
"""

_NEAR = rf"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), {_WORD}) as w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i : i + 3], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
both_ as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from both_ join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 80 * (x.n + y.n - c)),
ways as (select a as x, b as y from links union all select b, a from links),
reach(x, y) as (
  select x, y from ways union select r.x, w.y from reach r join ways w on r.y = w.x)
select d.doc_id, coalesce(s.n, 0) as n_shingles, c.root as component_id, d.doc_id = c.root as kept
from words d left join sizes s using (doc_id)
     join (select k.doc_id, least(k.doc_id, coalesce(min(r.y), k.doc_id)) as root
           from words k left join reach r on r.x = k.doc_id group by k.doc_id) c on c.doc_id = d.doc_id
"""

_LINES = f"""
with numbered as (select row_number() over () as k, doc_id, text, source, string_split(coalesce(text, ''), chr(10)) as parts from documents),
lines as (select k, source, unnest(parts) as line, unnest(range(len(parts))) as pos from numbered),
bare as (select *, trim(line, chr(9) || chr(11) || chr(12) || chr(13) || ' ') as b from lines),
bad as (
  select b from bare where b <> '' group by b
  having count(distinct coalesce('=' || source, '')) >= {MIN_SITES}),
joined as (
  select k, count(*) as n_lines, count(bad.b) as n_removed,
         coalesce(string_agg(line, chr(10) order by pos) filter (where bad.b is null), '') as text
  from bare left join bad on bare.b = bad.b group by k)
select n.doc_id, case when n.text is not null then j.text end as text, j.n_lines, j.n_removed
from numbered n join joined j using (k)
"""

_HITS = rf"""
with items as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(text, {_UPPER}), {_ALNUM}) as w
  from benchmark where item_id is not null and text is not null),
windows as (
  select distinct item, least(len(w), 10) as n, array_to_string(w[i : i + 9], ' ') as g
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)),
docs as (
  select row_number() over () as k, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), {_ALNUM}) as w from documents),
places as (
  select k, n, i, array_to_string(w[i : i + n - 1], ' ') as g
  from (select k, w, n, unnest(range(1, len(w) - n + 2)) as i
        from docs, (select distinct n from windows) where len(w) >= n)),
found as (select p.k, p.i, p.n, v.item from places p join windows v on p.n = v.n and p.g = v.g),
hit as (select k, count(distinct pos) as n_hit from (select k, unnest(range(i, i + n)) as pos from found) group by k),
named as (
  select k, count(*) as n_items, string_agg(item, ',' order by item) as list
  from (select distinct k, item from found) group by k)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(m.n_items, 0) as n_items,
       sha256(coalesce(m.list, '')) as items_sha256, h.n_hit is not null as contaminated
from docs d left join hit h using (k) left join named m using (k)
"""

_FIM = rf"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as hx from documents),
u as (
  select doc_id, t, regexp_extract_all(t, {_UNIT}) as toks,
         cast('0x' || substr(hx, 1, 8) as bigint) as h1, cast('0x' || substr(hx, 9, 8) as bigint) as h2,
         cast('0x' || substr(hx, 17, 8) as bigint) as h3, cast('0x' || substr(hx, 25, 8) as bigint) as h4
  from d),
k as (
  select *, least(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) as k1, greatest(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) as k2,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain'
              when h4 % 100 < 80 then 'spm' else 'psm' end as form
  from u),
p as (
  select *, array_to_string(toks[1 : k1], '') as pre, array_to_string(toks[k1 + 1 : k2], '') as mid,
         array_to_string(toks[k2 + 1 : len(toks)], '') as suf
  from k)
select doc_id, cast(len(toks) as bigint) as n, form,
       case when form = 'plain' then null else cast(length(pre) as bigint) end as prefix_chars,
       case when form = 'plain' then null else cast(length(mid) as bigint) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                        else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
       sha256(t) as restored_sha256
from p
"""

_TERM_BREAK = r"'[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
_SEARCH = rf"""
with d as (
  select doc_id, row_number() over () as k,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_UPPER}), {_TERM_BREAK}), lambda x: x <> '') as t
  from documents),
s as (select count(*) filter (where len(t) > 0) as nn, sum(len(t)) as ll from d),
p as (
  select k, doc_id, n, term, count(*) as tf
  from (select k, doc_id, len(t) as n, unnest(t) as term from d) group by k, doc_id, n, term),
f as (
  select term, cast(floor(1000 * ln((2.0 * s.nn + 2) / (2.0 * count(*) + 1))) as bigint) as w
  from p, s group by term, s.nn),
q as (
  select distinct item_id, term from (
    select item_id, unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_UPPER}), {_TERM_BREAK}), lambda x: x <> '')) as term
    from benchmark)),
sc as (
  select q.item_id, p.k, p.doc_id,
         sum(f.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * p.n * s.nn) // s.ll)))) as score
  from q join p using (term) join f using (term), s group by q.item_id, p.k, p.doc_id),
r as (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id asc nulls last, k) as rank
  from sc where score > 0)
select item_id, cast(rank as integer) as rank, cast(doc_id as bigint) as doc_id, cast(score as bigint) as score
from r where rank <= 10
"""

ORACLE: dict[str, str] = {
    "op2_mixing": _MIX,
    "op4_minhash_forest": _NEAR,
    "op5_line_spread": _LINES,
    "op6_fm_index": _HITS,
    "op11_fill_in_middle": _FIM,
    "op12_lexical_search": _SEARCH,
}
