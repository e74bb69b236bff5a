"""Expected SQL (DuckDB) of the queries that SQL can express on whole tables."""

from __future__ import annotations

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

ANSWERS: dict[str, str] = {}

ANSWERS["op1_url_filter"] = r"""
with split as (
  select page_id, url, strpos(coalesce(url, ''), '://') as mark, substr(url, strpos(coalesce(url, ''), '://') + 3) as rest from pages),
named as (
  select page_id, url,
         case when mark > 0 then translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
         case when mark > 0 then regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) else '' end as path
  from split),
told as (
  select n.page_id, count(*) as n, sum(l.quality) as k
  from named n join labels l on l.doc_id = try_cast(nullif(regexp_extract(n.url, '://[^/?#]*/[a-z]+/([0-9]{1,15})', 1), '') as bigint)
  where l.quality is not null group by 1),
sums as (
  select host, coalesce(sum(n), 0)::double as n, coalesce(sum(k), 0)::double as k,
         regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as bare
  from named left join told using (page_id) group by host),
parts as (
  select *, string_split(bare, '.') as labels, array_to_string(list_slice(string_split(bare, '.'), -2, -1), '.') as two from sums),
suffixed as (
  select *, case when regexp_matches(host, '^[0-9.:]*$') then host
                 when two in ('co.uk','org.uk','ac.uk','com.au','com.br','com.cn','co.jp','co.in','co.nz','co.za') then two
                 else labels[-1] end as suffix from parts),
hosts as (
  select host, n, k, suffix,
         case when regexp_matches(host, '^[0-9.:]*$') then host
              else array_to_string(list_slice(labels, -(len(string_split(suffix, '.')) + 1), -1), '.') end as domain from suffixed),
overall as (select case when sum(n) > 0 then sum(k) / sum(n) else 0.5 end as m from hosts),
s0 as (select suffix, sum(n) as n, sum(k) as k, any_value(m) as m from hosts, overall group by suffix),
r0 as (select greatest(sum((k - n*m)*(k - n*m)/n - m*(1-m)) / nullif(sum(m*(1-m)*(n-1)), 0), 1e-9) as rho from s0 where n > 0),
t0 as (select coalesce(least(greatest(1/rho - 1, 2), 1000), 1000) as s from r0),
s1 as (select suffix, (s*m + k)/(s + n) as m from s0, t0),
d0 as (select h.domain, h.suffix, sum(n) as n, sum(k) as k, any_value(s1.m) as m from hosts h join s1 using (suffix) group by 1, 2),
r1 as (select greatest(sum((k - n*m)*(k - n*m)/n - m*(1-m)) / nullif(sum(m*(1-m)*(n-1)), 0), 1e-9) as rho from d0 where n > 0),
t1 as (select coalesce(least(greatest(1/rho - 1, 2), 1000), 1000) as s from r1),
d1 as (select domain, suffix, (s*m + k)/(s + n) as m from d0, t1),
h0 as (select h.host, h.n, h.k, d1.m from hosts h join d1 using (domain, suffix)),
r2 as (select greatest(sum((k - n*m)*(k - n*m)/n - m*(1-m)) / nullif(sum(m*(1-m)*(n-1)), 0), 1e-9) as rho from h0 where n > 0),
t2 as (select coalesce(least(greatest(1/rho - 1, 2), 1000), 1000) as s from r2),
h1 as (select host, n, k, s, (s*m + k)/(s + n) as mean from h0, t2),
rated as (
  select host, n, k, case when least(mean + 1.645*sqrt(mean*(1-mean)/(s+n+1)), 1) < 0.5 then 'block' else 'allow' end as verdict from h1),
ruled as (
  select page_id, host, path,
    case when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
         when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
         when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
         when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule
  from named)
select page_id, host, path, rule,
  case rule when 'net/' then 'block' when 'example.com/de/' then 'block' when 'example.net/en/' then 'allow' when 'org/fr/' then 'allow'
       else verdict end as verdict,
  n::bigint as labelled, k::bigint as good
from ruled join rated using (host)
"""

ANSWERS["op6_exact_dedup"] = r"""
with words as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id is not distinct from min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from words
"""

USABLE = """embedding is not null and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0"""

ANSWERS["op12_hard_negatives"] = f"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * x::double)::bigint for x in embedding] as q
  from embeddings where label is not null and {USABLE}),
s as (
  select a.vec_id as anchor, a.label as anchor_label, v.vec_id, v.label,
         list_sum([z[1] * z[2] for z in list_zip(a.q, v.q)])::bigint as score
  from v a join v on v.vec_id <> a.vec_id where a.vec_id % 100 = 0),
p as (
  select * from (select *, row_number() over (partition by anchor order by score desc, vec_id) as r from s where label = anchor_label) where r <= 5),
n as (
  select p.anchor, p.vec_id as positive, p.score as positive_score, s.vec_id as negative, s.score as negative_score,
         row_number() over (partition by p.anchor, p.vec_id order by s.score desc, s.vec_id) as r
  from p join s on s.anchor = p.anchor and s.label <> p.label and 80 * p.score <= 100 * s.score and s.score <= p.score)
select anchor as anchor_id, positive as positive_id, r::int as rank, negative as negative_id, positive_score, negative_score from n where r <= 5
"""


def _rounds(clusters: int, rounds: int, width: int) -> str:
    """Lloyd's rounds on integers, one after the other."""
    parts = [f"""v as (
  select vec_id, [floor(256 * x::double)::bigint for x in embedding] as q from embeddings where len(embedding) = {width} and {USABLE}),
c0 as (
  select k, q from (select row_number() over (order by sha256('2:' || vec_id::varchar)) - 1 as k, q from v) where k < {clusters})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} as materialized (
  select vec_id, any_value(v.q) as q, min(struct_pack(d := list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(v.q, c.q)])::bigint, k := c.k)) as m
  from v, c{i} c group by vec_id)""")
        if i < rounds:
            parts.append(f"""t{i} as (
  select m.k as k, i, sum(q[i])::bigint as s, count(*) as n from a{i}, range(1, {width + 1}) r(i) group by 1, 2),
c{i + 1} as materialized (
  select c.k, coalesce(t.q, c.q) as q
  from c{i} c left join (select k, list((s - ((s % n) + n) % n) // n order by i) as q from t{i} group by k) t on t.k = c.k)""")
    return f"""with {', '.join(parts)}
select a.vec_id, a.m.k::int as cluster, a.m.d as distance, sum(a.m.d) over (partition by a.m.k)::bigint as cluster_inertia,
       sum(a.m.d) over ()::bigint as inertia, sha256(array_to_string(c.q, ',')) as centroid_sha256
from a{rounds} a join c{rounds} c on c.k = a.m.k"""


ANSWERS["op13_centroids"] = _rounds(40, 5, 64)
