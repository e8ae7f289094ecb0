"""DuckDB SQL for the rows of the queries that SQL can express."""

_WORDS = r"[^\x20\x09-\x0D]+"

SQL = {
    "op4_embedding_near_dedup": """
with recursive v as (select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and list_dot_product(embedding::double[], embedding::double[]) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93),
r as (select vec_id as node, vec_id as seen from embeddings union select r.node, l.b from r join l on l.a = r.seen),
c as (select node, min(seen) as component_id from r group by node)
select e.vec_id, (select count(*) from l where l.a = e.vec_id) as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join c on c.node = e.vec_id""",
    "op6_top_k_search": """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0 and len(c.v) = len(q.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5""",
    "op12_hard_negatives": """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as alike, list_dot_product(a.v, b.v)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where a.vec_id % 100 = 0),
p as (select anchor_id, id as positive_id, score as positive_score from s where alike
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, id)::int as rank,
  id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not alike and 80 * positive_score <= 100 * score and score <= positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, id) <= 5""",
    "op13_phrase_mining": r"""
with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
g as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) as phrase
  from w, (values (1), (2), (3)) t(k) where len(w) >= k),
f as (select lang, k, phrase, count(*) as f from g group by all),
n as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= 10),
u as (select lang, k, phrase, a, unnest(range(1, k)) as cut, w from c),
s as (select u.lang, u.k, u.phrase, u.a, x.f as l, y.f as r, cut, ((1000000::hugeint * a * a) // (x.f::hugeint * y.f))::bigint as score
  from u join f x on x.lang = u.lang and x.phrase = array_to_string(w[1:cut], ' ')
  join f y on y.lang = u.lang and y.phrase = array_to_string(w[cut+1:], ' ')),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
h as (select lang, phrase, max(a) as longer from (select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase from c where k = 3) group by all),
o as (select b.* from b left join h on h.lang = b.lang and h.phrase = b.phrase where b.k = 3 or h.longer is null or 100 * h.longer < 50 * b.a)
select o.lang, row_number() over (partition by o.lang order by score desc, a desc, phrase)::int as rank, phrase, a, l, r, n.n, score
from o join n on n.lang = o.lang qualify row_number() over (partition by o.lang order by score desc, a desc, phrase) <= 2000""",
    "op3_substring_dedup": rf"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') as w from documents),
g as (select doc_id, i, array_to_string(w[i:i+12], ' ') as g from d, lateral (select unnest(range(1, len(w) - 11)) as i)),
m as (select g, min(doc_id) as first from g group by g),
c as (select distinct g.doc_id, i + j as at from g join m on m.g = g.g and m.first < g.doc_id, lateral (select unnest(range(0, 13)) as j)),
k as (select d.doc_id, i, w[i] as word, c.at is null as kept from d, lateral (select unnest(range(1, len(w) + 1)) as i) left join c on c.doc_id = d.doc_id and c.at = i)
select d.doc_id, len(d.w) as n_words, count(*) filter (not kept) as n_removed,
  sha256(coalesce(string_agg(word, ' ' order by i) filter (kept), '')) as kept_sha256
from d left join k on k.doc_id = d.doc_id group by d.doc_id, d.w""",
    "op7_ngram_jaccard_join": rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') as w
  from documents),
s as (
  select distinct doc_id, array_to_string(case when len(w) < 4 then w else w[i:i+3] end, ' ') as s
  from w, lateral (select unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) as i)),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id as node, doc_id as seen from documents union select r.node, e.b from r join e on e.a = r.seen)
select d.doc_id, coalesce(n.n, 0) as n_shingles, (select min(seen) from r where r.node = d.doc_id) as component_id
from documents d left join n on n.doc_id = d.doc_id""",
}


def _secret_scan() -> str:
    from zonalis.llm import credentials as c

    quoted = {k: p.replace("'", "''") for k, p in (c.BASE | c.WEAK).items()}
    tests = {"assign": f"length(regexp_extract(m, '{quoted['assign']}', 2)) >= {c.ASSIGN_LEAST}",
             "token": "regexp_matches(m, '[0-9]') and regexp_matches(m, '[A-Z]') and regexp_matches(m, '[a-z]')"}
    kinds = " union all ".join(
        f"""select doc_id, {at} as kind, '{k}' as name, finish - length(m) as start, finish from (
            select doc_id, m, sum(length(m) + length(g)) over (partition by doc_id order by i) as finish from (
            select doc_id, unnest(regexp_extract_all(text, '{p}')) as m, unnest(regexp_split_to_array(text, '{p}')) as g,
              unnest(range(len(regexp_extract_all(text, '{p}')) + 1)) as i from documents where regexp_matches(text, '{p}')))
          where m is not null and {tests.get(k, 'true')}""" for at, (k, p) in enumerate(quoted.items()))
    listed = "string_agg(name || ':' || start::bigint || ':' || finish::bigint, ',' order by start, kind)"
    return f"""
with p as ({kinds}),
clear as (select *, coalesce(max(case when kind < 3 then finish end) over (partition by doc_id order by start, kind rows between unbounded preceding and 1 preceding), 0) <= start
    and coalesce(min(case when kind < 3 then start end) over (partition by doc_id order by start, kind rows between 1 following and unbounded following), finish) >= finish as clear from p),
near as (select *, max((name in ('access', 'login'))::int) over w as who, max((name in ('assign', 'hex', 'token'))::int) over w as what
  from clear where kind < 3 or clear window w as (partition by doc_id order by start range between {c.SCOPE} preceding and {c.SCOPE} following)),
told as (select * from near where kind < 3 or (name = 'token' and who = 1) or (name = 'login' and what = 1) or (name = 'endpoint' and who = 1 and what = 1)),
s as (select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
  {listed} filter (kind < 3) as base, {listed} as spans from told group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join s on s.doc_id = d.doc_id"""


SQL["op10_secret_scan"] = _secret_scan()


def _fingerprints() -> str:
    from zonalis.llm import winnowing as f

    gram = " + ".join(f"coalesce(lead(code, {j}) over w, 0) * {pow(f._BASE, f.GRAM - 1 - j, f._PRIME)}" for j in range(f.GRAM))
    return f"""
with d as (select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, coalesce(
    lead(doc_id) over (order by doc_id), min(doc_id) over ()) as next_id from documents),
e as (select d.*, substr(d.t, 1, d.n - d.n // 2) || substr(x.t, 1, d.n // 2) as e from d join d x on x.doc_id = d.next_id),
s as (select doc_id, 'own' as kind, t as s from e union all select doc_id, 'edited', e from e),
l as (select doc_id, kind, regexp_extract_all(s, '(?s).') as l from s),
c as (select doc_id, kind, len(l) as n, generate_subscripts(l, 1) as i, ord(unnest(l))::bigint as code from l),
g as (select doc_id, kind, n, i, ({gram}) % {f._PRIME} as h from c window w as (partition by doc_id, kind order by i)),
m as (select doc_id, kind, n, i, min(h * 4294967296 + 4294967296 - i) over (partition by doc_id, kind order by i rows between current row and {f.WINDOW - 1} following) as v
  from g where i <= greatest(n - {f.GRAM - 1}, 1)),
k as (select distinct doc_id, kind, v // 4294967296 as h, 4294967295 - v % 4294967296 as p from m where i <= greatest(n - {f.GRAM + f.WINDOW - 2}, 1)),
w as (select doc_id, kind, string_agg(p || ':' || h, ',' order by p) as f, list(distinct h) as hs from k group by all),
o as (select e.doc_id, e.n as n_chars, sha256(e.e) as edited_sha256, coalesce(a.f, '') as fingerprint, coalesce(b.f, '') as edited_fingerprint,
  coalesce(a.hs, []) as x, coalesce(b.hs, []) as y, coalesce(c.hs, []) as z
  from e left join w a on a.doc_id = e.doc_id and a.kind = 'own' left join w b on b.doc_id = e.doc_id and b.kind = 'edited'
  left join w c on c.doc_id = e.next_id and c.kind = 'own')
select doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  case when len(x) + len(y) = 0 then 1.0::double else len(list_intersect(x, y))::double / len(list_distinct(x || y)) end as near_edited,
  case when len(x) + len(z) = 0 then 1.0::double else len(list_intersect(x, z))::double / len(list_distinct(x || z)) end as near_next from o"""


SQL["op11_document_fingerprints"] = _fingerprints()
