"""Text operators in SQL, for checking against another engine on small tables."""

from __future__ import annotations

from entityframe.llm.line_dedup import UPPER

_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
_ALNUM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PLAIN_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

OP3_SQL = """
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
parts as (
  select doc_id, 1000 * c as base, substr(h, 2000 * c + 1, 2098) as g
  from (select doc_id, h, unnest(range(0, length(h) // 2000 + 1)) as c from docs)),
windows as (
  select doc_id, base + i as i, substr(g, 2 * i + 1, 100) as k
  from (select *, unnest(range(0, least(1000, length(g) // 2 - 49))) as i
        from parts where length(g) >= 100)),
firsts as (select k, min(doc_id) as first from windows group by k),
starts as (select doc_id, i as p, true as hit from windows join firsts using (k) where first < doc_id),
bytes as (
  select doc_id, base + p as p, substr(g, 2 * p + 1, 2) as x
  from (select *, unnest(range(0, least(1000, length(g) // 2))) as p from parts)),
judged as (
  select doc_id, p, x, coalesce(bool_or(hit) over (partition by doc_id order by p
    rows between 49 preceding and current row), false) as gone
  from bytes left join starts using (doc_id, p)),
edged as (
  select *, gone and not coalesce(lag(gone) over (partition by doc_id order by p), false) as opens
  from judged),
counted as (
  select doc_id, count(*) filter (gone) as n_removed, count(*) filter (opens) as n_spans,
         string_agg(x, '' order by p) filter (not gone) as rest
  from edged group by doc_id)
select doc_id, length(h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed,
       coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(rest, ''))) as kept_sha256
from docs left join counted using (doc_id)
"""

OP4_SQL = f"""
with docs as (select doc_id, {_ALNUM_WORDS} as w from documents),
items as (select coalesce(item_id::varchar, 'None') as item_id, {_ALNUM_WORDS} as w from benchmark),
wanted as (
  select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as k
  from (select item_id, w, least(13, len(w)) as n, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i
        from items where len(w) > 0)),
windows as (
  select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as k
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from docs, (select distinct n from wanted) where len(w) >= n)),
found as (select doc_id, i, n, item_id from windows join wanted using (n, k)),
hit as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as names
  from (select distinct doc_id, item_id from found) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join hit using (doc_id) left join named using (doc_id)
"""

OP7_SQL = f"""
with recursive docs as (select doc_id, {_PLAIN_WORDS} as w from documents),
sets as (
  select distinct doc_id, s from (
    select doc_id, unnest(case when len(w) >= 4
      then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))
      when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
    from docs)),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
pairs as (
  select a.doc_id as x, b.doc_id as y, count(*) as k
  from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * k >= 85 * (p.n + q.n - k)),
edges as (select x, y from links union all select y, x from links),
reach as (
  select doc_id as node, doc_id as other from documents
  union
  select node, y from reach join edges on other = x)
select node as doc_id, coalesce(n, 0) as n_shingles, min(other) as component_id
from reach left join sizes on node = doc_id group by node, n
"""
