"""DuckDB SQL with the results of the dealt queries that SQL can express."""

OP5 = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as len,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as h
  from documents
)
select doc_id,
       first_value(doc_id) over (partition by h order by len desc, doc_id) as keep_id,
       count(*) over (partition by h) as group_size,
       doc_id = first_value(doc_id) over (partition by h order by len desc, doc_id) as kept,
       h as text_sha256
from d
"""

OP3 = r"""
with d as (
  select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as spot,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size
  from documents
), s as (
  select source, sum(size)::bigint as source_size from d group by source
), r as (
  select *, row_number() over (order by source asc nulls last) - 1 as sid from s
), w as (
  select *, [5, 2, 1][sid % 3 + 1] as weight, 2 * source_size as cap from r
), f as (
  select *,
    (1.5::double * sum(source_size) over ()
       - coalesce(sum(cap) over (order by cap / weight, sid rows between unbounded preceding and 1 preceding), 0))
    / (sum(weight) over ()
       - coalesce(sum(weight) over (order by cap / weight, sid rows between unbounded preceding and 1 preceding), 0)) as lev
  from w
), t as (
  select source, sid, source_size,
    case when lev * weight >= cap then cap::double
         else weight * max(case when lev * weight < cap then lev end) over () end as target
  from f
), p as (
  select *, sum(floor(target)::bigint) over (order by sid)::bigint as upto from t
), g as (
  select max(upto) as words, greatest(1, max(upto) // 262144) as block from p
), u as (
  select p.*, block, cast(ceil(source_size / block) as bigint) as blocks,
    case when upto = words then 4294967296 else floor(upto / words::double * 4294967296)::bigint end as upper
  from p, g
), k as (
  select unnest(range((select (words + block - 1) // block from g))) as k
), pt as (
  select k, (k::hugeint * 2654435769) % 4294967296 as point from k
), sl as (
  select pt.k, (select min(sid) from u where u.upper > pt.point) as sid from pt
), rk as (
  select sid, row_number() over (partition by sid order by k) - 1 as rank from sl
), used as (
  select rk.sid, rank % blocks as at, count(*) as uses
  from rk join u on rk.sid = u.sid where rank < 2 * blocks group by all
), ln as (
  select d.doc_id, d.size, u.sid, u.source_size, u.target, u.block,
    coalesce(sum(size) over (partition by u.sid order by spot, doc_id, size
      rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from d join u on d.source is not distinct from u.source
), met as (
  select *, unnest(range(start // block, (start + size - 1) // block + 1)) as at from ln where size > 0
), tk as (
  select met.doc_id, met.sid, met.start,
    sum((least(start + size, (met.at + 1) * block) - greatest(start, met.at * block)) * uses) as taken
  from met join used on met.sid = used.sid and met.at = used.at group by all
)
select ln.doc_id, ln.size, ln.source_size, ln.target, coalesce(tk.taken, 0)::bigint as taken
from ln left join tk on ln.doc_id = tk.doc_id and ln.sid = tk.sid and ln.start = tk.start and ln.size > 0
"""

OP7 = r"""
with p as (
  select page_id, coalesce(html, '') as html,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
           || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
           || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' as head,
         chr(13) || chr(10) || chr(13) || chr(10) as gap
  from pages
), r as (
  select page_id, head || strlen(html) || gap || html || gap as rec from p
), d as (
  select page_id, sha256(rec) as digest, strlen(rec)::bigint as n_bytes,
         coalesce(floor(page_id / 1000.0), -1)::bigint as warc_file,
         md5(coalesce(cast(page_id as varchar), '')) as spot
  from r
)
select page_id, warc_file,
  coalesce(sum(n_bytes) over (partition by warc_file
    order by substr(spot, 1, 2) || substr(digest, 1, 2), spot || digest, n_bytes
    rows between unbounded preceding and 1 preceding), 0)::bigint as record_offset,
  n_bytes,
  case when substr(digest, 1, 2) in ('00', '40', '80', 'c0', '02', '42', '82', 'c2') then 'changed'
       when substr(digest, 1, 2) in ('01', '41', '81', 'c1') then 'missing' else 'ok' end as status
from d
"""

OP8 = r"""
with r as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), p as (
  select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from r
), rules(verdict, h, q) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), u as (
  select distinct host, path from p
), f as (
  select host, path, arg_max(h || q, length(h || q)) as rule, arg_max(verdict, length(h || q)) as verdict
  from u join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, q)
  group by host, path
), l as (
  select distinct host, path from u where regexp_matches(host, '(^|\.)(cheap-pills|free-bets)\.')
)
select page_id, p.host, p.path, f.rule,
  coalesce(f.verdict, case when l.host is not null then 'block' else 'allow' end) as verdict
from p left join f on p.host = f.host and p.path = f.path
left join l on p.host = l.host and p.path = l.path
"""

OP1 = r"""
with d as (
  select row_number() over () as row, doc_id,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), p as (
  select row, unnest(w) as v, unnest(range(len(w))) as i from d
), g as (
  select row, i, v, lag(v) over (partition by row order by i) as u from p
), total as (
  select count(*) as n from p
), c1 as (
  select v, count(*) as c from g group by v
), c2 as (
  select u, v, count(*) as c from g where u is not null group by u, v
), o1 as (
  select row, v, count(*) as c from g group by row, v
), o2 as (
  select row, u, v, count(*) as c from g where u is not null group by row, u, v
), own as (
  select row, count(*) as n from g group by row
), s as (
  select g.row, coalesce(c2.c - o2.c, 0) as big, c1.c - o1.c as uni, cu.c - ou.c as con,
    greatest(1, total.n - own.n) as rest, g.u is not null as has
  from g join c1 on g.v = c1.v join o1 on g.row = o1.row and g.v = o1.v
    join own on g.row = own.row, total
    left join c2 on g.u = c2.u and g.v = c2.v
    left join o2 on g.row = o2.row and g.u = o2.u and g.v = o2.v
    left join c1 cu on g.u = cu.v left join o1 ou on g.row = ou.row and g.u = ou.v
), l as (
  select row,
    case when big > 0 then ln(big / con)
         else case when has then ln(0.4::double) else 0 end
              + case when uni > 0 then ln(uni / rest) else ln(0.4::double) - ln(rest) end end as x,
    case when big > 0 then 2 when uni > 0 then 1 else 0 end as used
  from s
), a as (
  select row, sum(x) as x, count(*) as n, count(*) filter (used = 2) as b, count(*) filter (used = 1) as u,
    count(*) filter (used = 0) as z
  from l group by row
)
select doc_id, coalesce(n, 0)::bigint as n_words, coalesce(b, 0)::bigint as n_bigram,
  coalesce(u, 0)::bigint as n_unigram, coalesce(z, 0)::bigint as n_unseen, round(coalesce(x, 0.0::double), 3) as log_score
from d left join a on d.row = a.row
"""

OP4 = r"""
with recursive d as (
  select row_number() over () as row, doc_id,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), s as (
  select distinct row, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i + 4], ' ') end as g
  from (select row, w, unnest(range(1, greatest(2, len(w) - 3))) as i from d where len(w) > 0)
), n as (
  select row, count(*) as n from s group by row
), sets as (
  select row, md5(string_agg(g, chr(10) order by g)) as h from s group by row
), one as (
  select h, min(row) as row from sets group by h
), p as (
  select a.row as a, b.row as b, count(*) as c
  from s a join s b on a.g = b.g and a.row < b.row
  where a.row in (select row from one) and b.row in (select row from one)
  group by all
), linked as (
  select a, b from p join n x on a = x.row join n y on b = y.row where 100 * c >= 75 * (x.n + y.n - c)
), edges as (
  select a, b from linked union select b, a from linked
  union select one.row, sets.row from one join sets using (h) where one.row <> sets.row
  union select sets.row, one.row from one join sets using (h) where one.row <> sets.row
), reach(a, b) as (
  select row, row from d
  union select reach.a, edges.b from reach join edges on reach.b = edges.a
)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, min(o.doc_id) as component_id
from d left join n on d.row = n.row join reach on d.row = reach.a join d o on reach.b = o.row
group by d.row, d.doc_id, n.n
"""

#: CRC-32 of the UTF-8 bytes: the table of a byte's eight steps, then a step per byte.
_CRC = r"""
steps as (
  select list_transform(range(256), lambda b:
    list_reduce(list_prepend(b, range(8)), lambda c, i:
      case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as tab
), crc as (
  select doc_id, size, source, lang, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint,
      list_transform(range(size - 8), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) as text_crc32
  from (select doc_id, source, lang, strlen(coalesce(text, '')) + 8 as size, hex(coalesce(text, '')) as h
        from documents), steps
)"""


def _kd_level(k: int) -> str:
    """One level of the tree: rows r{k} with node and shards (n) become r{k + 1}."""
    widths = ", ".join(f"coalesce((max(m{d}) - min(m{d})) / nullif(any_value(g{d}), 0), 0)" for d in range(3))
    return f"""
s{k} as (
  select node, [{widths}] as w, sum(size)::bigint * (any_value(n) // 2) // any_value(n) as cut
  from r{k}, g where n > 1 group by node
), o{k} as (
  select r{k}.*, cut, coalesce(sum(size) over (partition by r{k}.node order by
      case list_position(w, list_max(w)) when 1 then m0 when 2 then m1 when 3 then m2 end, doc_id nulls last
      rows between unbounded preceding and 1 preceding), 0) as before
  from r{k} left join s{k} on r{k}.node = s{k}.node
), r{k + 1} as (
  select doc_id, size, text_crc32, m0, m1, m2,
    case when n = 1 or 2 * before + size <= 2 * cut then node else node + n // 2 end as node,
    case when n = 1 then 1 when 2 * before + size <= 2 * cut then n // 2 else n - n // 2 end as n
  from o{k}
)"""


_PLACE = "coalesce(('0x' || rpad(substr(hex({0}), 1, 14), 14, '0'))::bigint, 72057594037927936)"

OP12 = f"""
with {_CRC}, r0 as (
  select doc_id, size, text_crc32, size as m0, {_PLACE.format('source')} as m1, {_PLACE.format('lang')} as m2,
    0 as node, 24 as n
  from crc
), g as (
  select max(m0) - min(m0) as g0, max(m1) - min(m1) as g1, max(m2) - min(m2) as g2 from r0
), {", ".join(_kd_level(k) for k in range(5))}
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'bytes' as law, node::int as shard,
  row_number() over (partition by node order by doc_id nulls last) - 1 as slot, null::int as grown_shard
from r5
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"

OP13 = f"""
with q as (
  select item_id, unnest(list_distinct({_TERMS})) as term from benchmark
), d as (
  select doc_id, {_TERMS} as terms from documents where text is not null
), l as (
  select doc_id, terms, len(terms)::bigint as n from d where len(terms) > 0
), g as (
  select count(*)::bigint as total, sum(n)::bigint as terms from l
), p as (
  select doc_id, n, term, count(*)::bigint as tf
  from (select doc_id, n, unnest(terms) as term from l)
  where term in (select term from q) group by all
), w as (
  select term, floor(1000 * ln((2 * any_value(total) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from p, g group by term
), i as (
  select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * total) // terms))) as impact
  from p join w using (term), g
), s as (
  select item_id, doc_id, sum(impact)::bigint as score from q join i using (term) group by all having sum(impact) > 0
)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s)
where rank <= 50
"""


ORACLES = {
    "op1_lm_scoring": OP1,
    "op3_source_mix": OP3,
    "op4_jaccard_join": OP4,
    "op5_exact_dedup": OP5,
    "op7_warc_fixity": OP7,
    "op8_url_filter": OP8,
    "op12_kd_sharding": OP12,
    "op13_lexical_search": OP13,
}
