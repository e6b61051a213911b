"""DuckDB SQL that gives the same rows as the queries of this package."""

from __future__ import annotations


def near_classes(words: int, percent: int, kept: bool) -> str:
    """Documents linked by sets of word shingles, and the smallest id that each can reach."""
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(words))
    return rf"""with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), shingles as materialized (
  select distinct doc_id, {shingle} as s
  from (select doc_id, w, unnest(range(1, len(w) - {words - 2})) as i from texts where len(w) >= {words})
  union all
  select doc_id, array_to_string(w, ' ') from texts where len(w) between 1 and {words - 1}
), sizes as materialized (
  select doc_id, count(*) as n from shingles group by doc_id
), links as materialized (
  select a, b from (
    select x.doc_id as a, y.doc_id as b, count(*) as common
    from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by x.doc_id, y.doc_id
  ) join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 100 * common >= {percent} * (p.n + q.n - common)
), reached(doc_id, other) as (
  select doc_id, doc_id from texts
  union
  select r.doc_id, l.b from reached r join links l on r.other = l.a
), lowest as (
  select doc_id, min(other) as component_id from reached group by doc_id
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id{", doc_id = component_id as kept" if kept else ""}
from lowest left join sizes using (doc_id)
"""


def centroids(k: int = 16, rounds: int = 3, width: int = 64, scale: int = 64, seed: int = 1) -> str:
    """Centroid clustering by plain comparison with every centroid."""
    steps = []
    for turn in range(rounds + 1):
        steps.append(f"""owned{turn} as materialized (
  select vec_id, any_value(v) as v, arg_min(cluster, d * {k} + cluster) as cluster, min(d) as distance from (
    select kept.vec_id, kept.v, c.cluster,
      list_sum(list_transform(list_zip(kept.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
    from kept, centroids{turn} c
  ) group by vec_id
)""")
        if turn < rounds:
            steps.append(f"""means{turn} as (
  select cluster, list(mean order by i) as v from (
    select cluster, i, ((s - ((s % n) + n) % n) // n)::bigint as mean from (
      select cluster, i, sum(v[i])::bigint as s, count(*) as n from owned{turn}, range(1, {width + 1}) r(i) group by cluster, i
    )
  ) group by cluster
), centroids{turn + 1} as materialized (
  select c.cluster, coalesce(m.v, c.v) as v from centroids{turn} c left join means{turn} m using (cluster)
)""")
    return f"""with kept as materialized (
  select vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v,
    row_number() over (order by sha256('{seed}:' || vec_id::varchar)) - 1 as place
  from embeddings
  where len(embedding) = {width} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), centroids0 as materialized (
  select place::integer as cluster, v from kept where place < {k}
), {", ".join(steps)}
select vec_id, cluster, distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia,
  (sum(distance) over ())::bigint as inertia, sha256(array_to_string(c.v, ',')) as centroid_sha256
from owned{rounds} join centroids{rounds} c using (cluster)
"""


HARD_NEGATIVES = """with given as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as cells
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as materialized (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
    list_sum(list_transform(list_zip(a.cells, b.cells), lambda z: z[1] * z[2]))::bigint as score
  from given a join given b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.positive_id,
  (row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id))::integer as rank,
  s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
where 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify rank <= 10
"""

BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|details|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|"
    "header|hr|html|li|main|nav|ol|option|p|pre|section|summary|table|tbody|td|tfoot|th|thead|title|tr|ul"
)
PAGE_LINES = rf"""with cut as materialized (
  select page_id, nullif(lower(regexp_extract(url,
      '(?i)^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]]*\]|[^/?#:]+)', 1)), '') as host,
    list_filter(list_transform(string_split_regex(regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'),
      '(?i)</?(?:{BLOCKS})\b[^>]*>', chr(10), 'g'), '<[a-zA-Z/!][^>]*>', '', 'g'), '[\r\n]+'),
      lambda x: trim(x)), lambda x: x <> '') as lines
  from pages
), counted as materialized (
  select host, line, count(*) as pages from (select host, unnest(list_distinct(lines)) as line from cut) group by host, line
), totals as (
  select host, count(*) as all_pages from cut group by host
), shares as materialized (
  select c.host, line, pages, all_pages from counted c join totals t on c.host is not distinct from t.host where pages >= 5
), histogram as (
  select pages * 100 // all_pages as p, count(*) as n from shares group by 1
), sides as (
  select p, sum(n) over (order by p) as below, sum(p * n) over (order by p) as sum_below, sum(n) over () as total,
    sum(p * n) over () as weighted
  from histogram
), cuts as (
  select p + 1 as start, pow(sum_below * total - weighted * below, 2) / (below * (total - below)) as gap
  from sides where below < total
), best as (
  select greatest(2, least(10, coalesce((select start from cuts where gap > 0 order by gap desc, start limit 1), 10))) as percent
), often as (
  select host, list(line) as gone from shares where pages * 100 >= all_pages * (select percent from best) group by host
), everywhere as (
  select coalesce(list(line), []) as common from (
    select line from counted group by line
    having sum(pages) >= 5 and count(*) * 2 > (select count(*) from totals)
      and sum(pages) * 100 >= (select percent * (select count(*) from cut) from best)
  )
), kept as (
  select page_id, c.host, lines, list_filter(lines,
    lambda x: not list_contains(coalesce(o.gone, []), x) and not list_contains(e.common, x)) as kept
  from cut c cross join everywhere e left join often o on c.host is not distinct from o.host
)
select page_id, host, coalesce(len(lines), 0)::bigint as n_lines,
  (coalesce(len(lines), 0) - coalesce(len(kept), 0))::bigint as n_dropped,
  case when lines is not null then coalesce(array_to_string(kept, chr(10)), '') end as text
from kept
"""
