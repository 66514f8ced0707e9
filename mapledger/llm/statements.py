"""DuckDB statements of the registered queries that SQL can express."""

from __future__ import annotations

#: Pairs by brute force, classes by a recursive closure of the links.
ROTATION_CODES = """
with recursive v as (
  select vec_id, cast(embedding as double[]) as e from embeddings where vec_id is not null and len(embedding) > 0),
u as (
  select vec_id, e, sqrt(list_dot_product(e, e)) as size from v
  where len([x for x in e if x is null or not isfinite(x)]) = 0 and len([x for x in e if x <> 0]) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.9),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
classes as (select a, min(b) as least from reach group by a),
counted as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(n.n, 0) as n_links, least(e.vec_id, coalesce(c.least, e.vec_id)) as component_id,
  e.vec_id <= coalesce(c.least, e.vec_id) as kept
from embeddings e left join counted n on n.a = e.vec_id left join classes c on c.a = e.vec_id
"""

#: Every window of 400 bytes is counted; removed runs are islands of the starts that occur again. Characters that a run
#: cuts in two are not in the kept text.
REPEATS = """
with t as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
windows as (select doc_id, unnest(range(0, cast(len(h) / 2 as bigint) - 399)) as s, h from t where len(h) >= 800),
hashed as (select doc_id, s, md5(substr(h, 2 * s + 1, 800)) as w from windows),
twice as (select w from hashed group by w having count(*) > 1),
again as (select doc_id, s from hashed join twice using (w)),
stepped as (select doc_id, s, case when s - lag(s) over (partition by doc_id order by s) <= 400 then 0 else 1 end as opens from again),
numbered as (select doc_id, s, sum(opens) over (partition by doc_id order by s) as run from stepped),
runs as (select doc_id, run, min(s) as a, max(s) + 400 as b from numbered group by doc_id, run),
gaps as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as before from runs),
kept as (
  select g.doc_id, sum(b - a) as n_removed, count(*) as n_spans, max(b) as last_end,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as head,
    string_agg(decode(unhex(regexp_replace(regexp_replace(substr(h, 2 * before + 1, 2 * (a - before)), '^([89AB][0-9A-F])+', ''), '([CD][0-9A-F]|E[0-9A-F]([89AB][0-9A-F])?|F[0-9A-F]([89AB][0-9A-F]){0,2})$', ''))), '' order by a) as head_text
  from gaps g join t on t.doc_id = g.doc_id group by g.doc_id)
select t.doc_id, cast(len(h) / 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(unhex(case when last_end is null then h else head || substr(h, 2 * last_end + 1) end)) as kept_sha256,
  case when last_end is null then decode(unhex(h)) else head_text || decode(unhex(regexp_replace(regexp_replace(substr(h, 2 * last_end + 1), '^([89AB][0-9A-F])+', ''), '([CD][0-9A-F]|E[0-9A-F]([89AB][0-9A-F])?|F[0-9A-F]([89AB][0-9A-F]){0,2})$', ''))) end as kept_text
from t left join kept k on k.doc_id = t.doc_id
"""

#: Intersections by a self-join on shingles, classes by a recursive closure of the links.
MINMAX = """
with recursive w as (
  select doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+') if x <> ''] as words from documents),
shingles as (
  select distinct doc_id, unnest(case when len(words) = 0 then cast([] as varchar[]) when len(words) < 5 then [array_to_string(words, ' ')]
    else [array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)] end) as g from w),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as n_shared from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id group by all),
half as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * n_shared >= 85 * (x.n + y.n - n_shared)),
links as (select a, b from half union all select b, a from half),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
classes as (select a, min(b) as least from reach group by a)
select d.doc_id, coalesce(s.n, 0) as n_shingles, least(d.doc_id, coalesce(c.least, d.doc_id)) as component_id,
  d.doc_id <= coalesce(c.least, d.doc_id) as kept
from documents d left join sizes s on s.doc_id = d.doc_id left join classes c on c.a = d.doc_id
"""

#: Every node's key is the row of its turns' digests, so that an ancestor's key is a prefix of it.
PREFIX_TRIE = r"""
WITH table_of_crc AS (
  SELECT list(v ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, _ : CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM range(256) AS r(n))),
ids AS (SELECT conv_id AS c, count(*) AS n FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
shares AS (
  SELECT c, n, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x : ascii(x)::BIGINT)),
      lambda s, b : xor(s // 256, t[1 + (xor(s, b) & 255)])), 4294967295) % 4 AS h
  FROM ids, table_of_crc),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos,
    md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
lent AS (SELECT c, pos, digest, words FROM shares JOIN turns ON conv_id = c - c % 20 AND pos <= h),
rebuilt AS (
  SELECT c, pos, digest, words FROM lent UNION ALL
  SELECT c, pos - h + coalesce(k, 0), digest, words FROM shares JOIN turns ON conv_id = c AND pos > h
  LEFT JOIN (SELECT c, count(*) AS k FROM lent GROUP BY 1) USING (c)),
rows_of AS (SELECT c, list(digest ORDER BY pos) AS l FROM rebuilt GROUP BY 1),
paths AS (
  SELECT r.c, pos AS d, words, array_to_string(list_slice(l, 1, pos), '') AS k, pos = len(l) AS is_end
  FROM rebuilt r JOIN rows_of USING (c)
  UNION ALL SELECT c, 0, 0, '', c NOT IN (SELECT c FROM rows_of) FROM ids),
nodes AS (
  SELECT k, d, min(c) AS c, count(*) AS n, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE is_end), '')) AS ends
  FROM paths GROUP BY 1, 2),
children AS (SELECT left(k, 32 * (d - 1)) AS k, count(*) AS m FROM nodes WHERE d > 0 GROUP BY 1),
own AS (SELECT nodes.*, coalesce(m, 0) AS m FROM nodes LEFT JOIN children USING (k)),
sums AS (
  SELECT left(k, 32 * a) AS k, sum(CASE WHEN m = 0 THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * words) AS saved
  FROM (SELECT own.*, unnest(range(d + 1)) AS a FROM own) GROUP BY 1)
SELECT o.c AS conv_id, o.d::BIGINT AS depth, p.c AS parent_conv_id, o.n::BIGINT AS n_convs, o.m::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, o.ends AS ends_sha256
FROM own o JOIN sums USING (k) LEFT JOIN own p ON o.d > 0 AND p.k = left(o.k, 32 * (o.d - 1))
"""
