"""DuckDB SQL for the registered queries, put together from named common table expressions."""

from __future__ import annotations

from phrasegrove.functions.prompts import FALLBACK, SYSTEM_TEXT, USER_TEXT

DAY = "date '2024-01-15'"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# Cells of the vectors, and the centroids of the three levels.
CELLS = """
l as (select cast(vec_id as varchar) as id, label, unnest(range(len(embedding))) as d,
             cast(unnest(embedding) as double) as x from embeddings)"""
CENTRES = f"""{CELLS},
c1 as (select label as cid, d, avg(x) as c from l group by 1, 2),
c2 as (select cid % 4 as cid, d, avg(c) as c from c1 group by 1, 2),
c3 as (select cid % 2 as cid, d, avg(c) as c from c2 group by 1, 2)"""


def nearest(name: str, points: str, key: str, value: str, centres: str) -> str:
    return f"""
{name} as (select {key}, cid, d2 from (
  select *, row_number() over (partition by {key} order by d2, cid) as r from (
    select p.{key} as {key}, q.cid as cid, round(sum((p.{value} - q.c) * (p.{value} - q.c)), 9) as d2
    from {points} p join {centres} q on p.d = q.d group by 1, 2)) where r = 1)"""


C1_ROWS = "pc1 as (select cid as child, d, c from c1), pc2 as (select cid as child, d, c from c2)"
MAPPING = f"""{CENTRES}, {C1_ROWS},{nearest("up1", "pc1", "child", "c", "c2")},{nearest("up2", "pc2", "child", "c", "c3")},
m as (select up1.child as cluster_n1, up1.cid as cluster_n2, up2.cid as cluster_n3
      from up1 join up2 on up1.cid = up2.child)"""
NEAREST = f"""{CENTRES},{nearest("a", "l", "id", "x", "c1")}"""
ASSIGNED = f"""{MAPPING},{nearest("a", "l", "id", "x", "c1")},
h as (select a.id, a.cid as cluster_n1, m.cluster_n2, m.cluster_n3, a.d2 as distance
      from a left join m on a.cid = m.cluster_n1)"""
SAMPLES = f"""{ASSIGNED},
r as (select h.*, row_number() over (partition by cluster_n1 order by distance, id) as position
      from h),
s as (select r.*, t.text as frase from r
      left join (select cast(doc_id as varchar) as id, text from documents) t on t.id = r.id
      where r.position <= 10)"""


def words(text: str) -> str:
    return f"list_transform(regexp_extract_all({text}, '[\\p{{L}}]+'), lambda w: lower(w))"


def terms(name: str, groups: str) -> str:
    """Names from ``groups(cluster_id, word)``: the most frequent words, ties by word."""
    return f"""
{name}_t as (select cluster_id, word, row_number() over (
    partition by cluster_id order by count(*) desc, word) as place
  from {groups} where length(word) >= 3 group by cluster_id, word),
{name} as (select cluster_id,
    string_agg(word, ' ' order by place) filter (where place <= 3) as nome,
    string_agg(word, ', ' order by place) filter (where place <= 8) as dor
  from {name}_t group by cluster_id)"""


NAMES = f"""{SAMPLES},
w1 as (select cluster_n1 as cluster_id, unnest({words("frase")}) as word from s
       where frase is not null),{terms("n1", "w1")},
ch2 as (select distinct m.cluster_n2 as cluster_id, m.cluster_n1 as child, n1.nome
        from m left join n1 on n1.cluster_id = m.cluster_n1),
w2 as (select cluster_id, unnest({words("nome")}) as word from ch2),{terms("n2", "w2")},
ch3 as (select distinct m.cluster_n3 as cluster_id, m.cluster_n2 as child, n2.nome
        from m left join n2 on n2.cluster_id = m.cluster_n2),
w3 as (select cluster_id, unnest({words("nome")}) as word from ch3),{terms("n3", "w3")},
wide as (select m.*, n1.nome as nome_n1, n1.dor as dor_n1, n2.nome as nome_n2, n2.dor as dor_n2,
                n3.nome as nome_n3, n3.dor as dor_n3
         from m left join n1 on n1.cluster_id = m.cluster_n1
                left join n2 on n2.cluster_id = m.cluster_n2
                left join n3 on n3.cluster_id = m.cluster_n3)"""
WIDE_COLUMNS = """cluster_n1, cluster_n2, cluster_n3, nome_n1, dor_n1, nome_n2, dor_n2,
                  nome_n3, dor_n3"""

DOCS = "docs as (select cast(doc_id as varchar) as id, text as frase from documents)"
STORED = "stored as (select distinct cast(vec_id as varchar) as id from embeddings)"
FRESH = f"{DOCS}, {STORED}, fresh as (select * from docs where id not in (select id from stored))"


def silhouette(prefix: str, cells: str, group: str) -> str:
    """Per-point scores ``{prefix}_s(id, g, s)`` of cells ``(id, g, d, x)``."""
    p = prefix
    return f"""
{p}_y as (select {group} as g, d, sum(x) as y from {cells} group by 1, 2),
{p}_x as (select id, {group} as g, sum(x * x) as xx from {cells} group by 1, 2),
{p}_p as (select g, count(*) as n, sum(xx) as psi from {p}_x group by 1),
{p}_d as (select c.id, c.{group} as g, y.g as other, sum(c.x * y.y) as xy
          from {cells} c join {p}_y y on c.d = y.d group by 1, 2, 3),
{p}_m as (select t.id, t.g, t.other, p.n,
                 greatest((p.n * i.xx + p.psi - 2 * t.xy) / p.n, 0) as md
          from {p}_d t join {p}_p p on p.g = t.other join {p}_x i on i.id = t.id),
{p}_ab as (select id, g, max(case when g = other and n > 1 then md * n / (n - 1) end) as a,
                  max(case when g = other then n end) as n,
                  min(case when g <> other then md end) as b from {p}_m group by 1, 2),
{p}_s as (select id, g, case when b is null then null when n = 1 then 0.0
                 when a < b then 1 - a / b when a > b then b / a - 1 else 0.0 end as s
          from {p}_ab)"""


def level_wcss(cells: str, group: str) -> str:
    return f"""(select sum(v) from (select sum(x * x) - sum(x) * sum(x) / count(*) as v
                from {cells} group by {group}, d))"""


RAWS = """
raws as (
  select cast(doc_id as varchar) as id, text as frase from documents
  union all select cast(doc_id as varchar), text from documents where source in ('src1', 'src2')
  union all select null, text from documents where source = 'src3'),
vecs as (select cast(vec_id as varchar) as id from embeddings),
fresh_raws as (select * from raws where id is null or id not in (select id from vecs))"""

PROMPT_TEXTS = " union all ".join(
    f"select {level} as nivel, {sql_text(SYSTEM_TEXT[level])} as system_text, "
    f"{sql_text(USER_TEXT[level])} as user_text"
    for level in (1, 2, 3)
)


ORACLES = {
    "scan_day_filter": f"""
select event_id, user_id, event_type, value from events where cast(ts as date) = {DAY}""",
    "sink_roundtrip": """
select cast(doc_id as varchar) as id, text as frase from documents
union all
select 'c' || conv_id || '-' || turn as id, text as frase from conversations""",
    "sink_overwrite": f"""
select event_id, case when cast(ts as date) = {DAY} then -value else value end as value,
       cast(ts as date) as day from events""",
    "table_counts": """
select 'documents' as name, count(*) as n from documents
union all select 'conversations', count(*) from conversations
union all select 'embeddings', count(*) from embeddings
union all select 'events', count(*) from events""",
    "existing_ids": "select distinct cast(vec_id as varchar) as id from embeddings",
    "new_phrases": f"with {RAWS} select id, frase from fresh_raws",
    "new_phrases_first_run": f"with {DOCS} select id, frase from docs",
    "embedding_reconcile": f"""
with {RAWS}
select (select count(*) from raws) as total_raw,
       (select count(*) from raws where id in (select id from vecs)) as already_embedded,
       (select count(*) from fresh_raws) as new_phrases,
       (select count(*) from vecs) as existing_ids,
       (select count(*) from vecs) + (select count(*) from fresh_raws) as cumulative""",
    "phrase_batches": f"""
with {DOCS}
select id, cast(floor((row_number() over (order by substr(md5(id), 1, 3), id) - 1) / 500)
                as bigint) as batch_no from docs""",
    "hash_sample": f"with {DOCS} select id from docs where substr(md5(id), 1, 8) < '33333333'",
    "exact_sample": f"""
with {RAWS}
select id, count(*) as n from raws
where id in (select id from (select distinct id from raws where id is not null)
             order by substr(md5(id), 1, 15), id limit 100)
group by id""",
    "embed_documents": f"""
with {DOCS},
w as (select id, unnest({words("frase")}) as word from docs),
b as (select id, cast('0x' || substr(md5(word), 1, 4) as integer) % 64 as dim,
             cast(count(*) as double) as n from w group by 1, 2)
select id, cast(dim as integer) as dim, round(cast(cast(
         n / sqrt(sum(n * n) over (partition by id)) as float) as double), 6) as value from b""",
    "day_embeddings_union": f"""
with {FRESH},{CELLS}
select id, 'stored' as origin, count(*) as n_dims, round(sqrt(sum(x * x)), 5) as size
from l group by id
union all
select id, 'new', 64,
       case when len({words("frase")}) > 0 then 1.0 else 0.0 end from fresh""",
    "l2_normalize": f"""
with {CELLS},
n as (select id, sqrt(sum(x * x)) as size from l group by 1)
select id, cast(d as integer) as dim,
       round(case when size > 0 then x / size else x end, 6) + 0.0 as value
from l join n using (id)""",
    "covariance": f"""
with {CELLS}
select cast(p.d as integer) as i, cast(q.d as integer) as j,
       round(covar_samp(p.x, q.x), 8) + 0.0 as cov
from l p join l q on p.id = q.id and p.d <= q.d group by 1, 2""",
    "centroids": f"""
with {CENTRES}
select cid as cluster_id, cast(d as integer) as dim, round(c, 6) + 0.0 as value from c1""",
    "nearest_centroid": f"""
with {NEAREST} select id, cid as cluster_id, round(d2, 6) as distance from a""",
    "lloyd_step": f"""
with {NEAREST}
select a.cid as cluster_id, cast(l.d as integer) as dim, round(avg(l.x), 6) + 0.0 as value
from l join a using (id) group by 1, 2""",
    "wcss": f"""
with {CELLS},
v as (select label, d, count(*) as n, sum(x * x) - sum(x) * sum(x) / count(*) as v
      from l group by 1, 2)
select label as cluster_id, max(n) as n, round(sum(v), 6) as wcss from v group by 1""",
    "silhouette": f"""
with {CELLS},{silhouette("p", "l", "label")}
select g as cluster_id, count(*) as n, round(avg(s), 6) + 0.0 as silhouette,
       avg(s) < 0.3 as below_threshold
from p_s group by 1""",
    "elbow": f"""
with {CELLS}, ks as (select unnest([2, 3, 5, 8, 10]) as k),
v as (select k, label % k as g, d, sum(x * x) - sum(x) * sum(x) / count(*) as v
      from l cross join ks group by 1, 2, 3),
i as (select k, sum(v) as inertia from v group by 1),
f as (select k, inertia, inertia / max(inertia) over () as scaled from i),
b as (select k, inertia, lead(scaled) over (order by k) - 2 * scaled
             + lag(scaled) over (order by k) as curvature from f)
select k, round(inertia, 6) as inertia, round(curvature, 6) + 0.0 as curvature,
       row_number() over (order by curvature desc nulls last, k) = 1 as recommended from b""",
    "cluster_mapping": f"with {MAPPING} select cluster_n1, cluster_n2, cluster_n3 from m",
    "mapping_pairs": f"with {MAPPING} select distinct cluster_n2, cluster_n3 from m",
    "assign_hierarchy": f"""
with {ASSIGNED} select id, cluster_n1, cluster_n2, cluster_n3 from h""",
    "embedding_quality": """
with given as (
  select embedding from embeddings
  union all
  select case label when 0 then embedding[1:63] when 2 then list_append(embedding[1:63], 'nan'::float)
         when 3 then list_append(embedding[1:63], null::float) end
  from embeddings where label in (0, 1, 2, 3)),
e as (select len(embedding) as n_dims,
  coalesce(len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or isnan(x))) = 0,
           false) as valid from given)
select cast(n_dims as integer) as n_dims, count(*) as n_rows,
       count(*) filter (where valid) as n_valid, count(*) filter (where not valid) as n_invalid
from e group by 1""",
    "assignment_quality": f"""
with {ASSIGNED}
select count(*) + (select count(*) from embeddings where label in (0, 1, 2, 3)) as n_rows,
       (select count(*) from embeddings where label in (0, 1, 2, 3)) as n_unassigned,
       min(cluster_n1) as min_cluster, max(cluster_n1) as max_cluster,
       count(distinct cluster_n1) as n_clusters from h""",
    "run_metrics": f"""
with {MAPPING},
p1 as (select child as id, cid as g, d, c as x from up1 join pc1 using (child)),
p2 as (select child as id, cid as g, d, c as x from up2 join pc2 using (child)),
{silhouette("q1", "l", "label")},{silhouette("q2", "p1", "g")},{silhouette("q3", "p2", "g")}
select 'labels' as run_id,
  (select count(distinct label) from l)::integer as k_n1,
  (select count(distinct g) from p1)::integer as k_n2,
  (select count(distinct g) from p2)::integer as k_n3,
  round((select avg(s) from q1_s)::float::double, 4) as silhouette_n1,
  round((select avg(s) from q2_s)::float::double, 4) as silhouette_n2,
  round((select avg(s) from q3_s)::float::double, 4) as silhouette_n3,
  round({level_wcss("l", "label")}::float::double, 4) as inertia_n1,
  round({level_wcss("p1", "g")}::float::double, 4) as inertia_n2,
  round({level_wcss("p2", "g")}::float::double, 4) as inertia_n3,
  (select count(distinct id) from l) as total_records, 64 as pca_dims""",
    "cluster_samples": f"""
with {SAMPLES}
select cluster_n1, position, id, round(distance, 6) as distance, frase from s""",
    "naming_prompt": f"""
with {SAMPLES},
g as (select cluster_n1 as cluster_id, count(frase) as n,
             string_agg('- ' || frase, chr(10) order by position) as bullets
      from s group by 1)
select cluster_id, nivel, n as n_phrases, system_text as system_prompt,
       replace(user_text, '%d', n::varchar) || chr(10) || chr(10)
         || coalesce(bullets, '') as user_prompt from g, ({PROMPT_TEXTS})""",
    "parse_name_json": f"""
with r as (select event_id, event_type in ('purchase', 'signup') as ok, event_type, user_id
           from events)
select event_id, ok, case when ok then event_type else '{FALLBACK}' end as nome,
       case when ok then 'need ' || user_id else '{FALLBACK}' end as dor from r""",
    "names_n1": f"""
with {NAMES}
select cluster_id, 1 as nivel, nome, dor, true as ok from n1""",
    "parent_children": f"""
with {NAMES}
select cluster_id, string_agg(nome, '|' order by child) as children from ch2 group by 1""",
    "names_parent": f"""
with {NAMES}
select cluster_id, 2 as nivel, nome, dor, true as ok from n2
union all select cluster_id, 3, nome, dor, true from n3""",
    "names_wide": f"with {NAMES} select {WIDE_COLUMNS} from wide",
    "names_long": f"""
with {NAMES}
select cluster_n1 as cluster_id, 1 as nivel, nome_n1 as nome, dor_n1 as dor from wide
union select cluster_n2, 2, nome_n2, dor_n2 from wide
union select cluster_n3, 3, nome_n3, dor_n3 from wide""",
    "enrich_names": f"""
with {NAMES}
select h.id, wide.cluster_n1, wide.cluster_n2, wide.cluster_n3, nome_n1, dor_n1, nome_n2,
       dor_n2, nome_n3, dor_n3, date '2024-02-01' as processed_on
from h left join wide using (cluster_n1)""",
    "model_roundtrip": "select count(*) as n_rows, cast(0 as bigint) as n_differ from embeddings",
    "stream_assign": f"""
with {ASSIGNED} select id, cluster_n1, cluster_n2, cluster_n3 from h""",
    "pca_project": """
select count(*) as n_rows, 16 as n_axes, count(*) filter (where embedding is null) as n_differ,
       0 as n_crooked from embeddings""",
    "train_level": """
select k, k as k_found, (select count(*) from embeddings) as n, 0::bigint as n_not_nearest,
       true as inertia_agrees from (select unnest([2, 5, 10, 20]) as k)""",
    "train_hierarchy": """
select count(*) as n_rows, count(*) filter (where embedding is null) as n_unassigned,
       0::bigint as n_split, true as mapped_all from embeddings""",
    "k_sweep": """
select k, true as elbow_agrees, true as inertia_falls, true as has_silhouette
from (select unnest([2, 5, 10, 20]) as k)""",
    "k_sweep_metrics": """
select 'sweep' as run_id, k as k_n1, 5 as n_filled, 8 as n_null
from (select unnest([2, 5, 10, 20]) as k)""",
    "stream_job": """
select 2::bigint as n_batches, count(*) as n_out, count(*) as n_ids,
       count(*) filter (where label in (0, 1, 2, 3)) as n_quarantined, 0::bigint as n_unassigned, 0::bigint as n_unnamed
from embeddings""",
    "job_training": """
select part, n::bigint as n, 0::bigint as n_bad
from (values ('names_1', 20), ('names_2', 8), ('names_3', 3), ('mapping', 20), ('metrics', 10)) t(part, n)""",
    "job_assignment": """
with new_docs as (
  select count(*) as n from documents where doc_id not in (select vec_id from embeddings)),
damaged as (select count(*) as n from embeddings where label in (0, 2, 3))
select new_docs.n + damaged.n as n_in, new_docs.n as n_out, damaged.n as n_quarantined,
       0::bigint as n_unassigned, 0::bigint as n_unnamed from new_docs, damaged""",
    "job_embedding": f"""
with {FRESH}
select id, 64 as n_dims, date '2024-01-14' as day from stored
union all select id, 64, date '2024-01-15' from fresh""",
}
