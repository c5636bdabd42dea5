"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_SPANS = """
    select doc_id, {order} as ord, '{kind}' as kind,
      list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) as start,
      length(hits[i]) as chars
    from (
      select doc_id, hits, between, checked, unnest(generate_series(1, len(hits))) as i
      from (
        select doc_id, regexp_extract_all(t, {pattern}, 0) as hits, regexp_extract_all(t, {pattern}, {group}) as checked,
          string_split_regex(t, {pattern}) as between
        from d
      )
    )
    where length(checked[i]) >= {least}"""

_ASSIGN = r"""'(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""


def _spans(order: int, kind: str, pattern: str, group: int, least: int) -> str:
    return _SPANS.format(order=order, kind=kind, pattern=pattern, group=group, least=least)


_SECRETS = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
s as (
  {_spans(0, "assign", _ASSIGN, 2, 12)}
  union all {_spans(1, "access", "'AKIA[A-Z0-9]+'", 0, 18)}
  union all {_spans(2, "hex", "'[0-9a-f]+'", 0, 16)}
  union all {_spans(3, "private", "'-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----'", 0, 1)}
),
j as (
  select doc_id, count(*) filter (ord = 0) as n_assign, count(*) filter (ord = 1) as n_access, count(*) filter (ord = 2) as n_hex,
    count(*) filter (ord = 3) as n_added,
    string_agg(kind || ':' || cast(start as bigint) || ':' || cast(start + chars as bigint), ',' order by start, ord) filter (ord < 3) as base,
    string_agg(kind || ':' || cast(start as bigint) || ':' || cast(start + chars as bigint), ',' order by start, ord) as spans
  from s group by doc_id
)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_added, 0) as n_added
from d left join j using (doc_id)
"""

_REPEATS = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (
  select doc_id, i, array_to_string(w[i:i+49], ' ') as win
  from (select doc_id, w, unnest(generate_series(1, len(w) - 49)) as i from d where len(w) >= 50)
),
repeats as (
  select doc_id, i from (select doc_id, i, min(doc_id) over (partition by win) as first_id from starts) where first_id < doc_id
),
covered as (select distinct doc_id, unnest(generate_series(i, i + 49)) as i from repeats),
gone as (select doc_id, list(i) as g from covered group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(g), 0) as bigint) as n_removed,
  sha256(coalesce(array_to_string(case when g is null then w else list_filter(w, lambda x, k: not list_contains(g, k)) end, ' '), '')) as kept_sha256
from d left join gone using (doc_id)
"""

_WARC = """
with p as (
  select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as digest from pages
),
f as (select *, min(page_id) over (partition by digest) as first_id from p)
select page_id, cast(n as bigint) as payload_bytes, digest as payload_digest,
  case when n >= 100 and page_id > first_id then 'revisit' else 'response' end as record_type,
  case when n >= 100 and page_id > first_id then first_id end as refers_to
from f
"""

_MIXING = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    length(coalesce(text, '')) as chars, length(translate(coalesce(text, ''), '!#$%&*|0123456789', '')) as plain
  from documents
),
k as (
  select doc_id, source, size,
    -ln((cast('0x' || substr(md5(cast(doc_id as varchar) || ':mix'), 1, 13) as bigint) + 0.5::double) / 4503599627370496.0::double)
      / (1.0::double - 0.5::double * least(1.0::double, 4.0::double * (case when chars > 0 then (chars - plain)::double / chars else 0 end))) as key
  from d
),
s as (select source, cast(sum(size) as bigint) as source_size from k group by source),
w as (
  select *, 3 * source_size as cap,
    [5, 2, 1][1 + (row_number() over (order by source is null, source collate c) - 1) % 3]::double as weight
  from s
),
l as (
  select *, cap / weight as level,
    (sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, source is null, source
       rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (order by cap / weight, source is null, source rows between current row and unbounded following) as common
  from w
),
t as (
  select source, source_size,
    case when level > common then round(weight * max(case when level > common then common end) over (), 6) else cap::double end as target
  from l
),
e as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as epochs from t
),
o as (
  select k.*, e.source_size, target, epochs, cast(round(target) as bigint) - epochs * e.source_size as left_over,
    coalesce(sum(size) over (partition by k.source order by key, size rows between unbounded preceding and 1 preceding), 0) as earlier
  from k join e on k.source is not distinct from e.source
)
select doc_id, size, source_size, target,
  cast(epochs * size + greatest(0, least(size, left_over - earlier)) as bigint) as taken
from o
"""

_CONTAINED = r"""
with d as (
  select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') as w from documents
),
b as (
  select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') as w from benchmark
),
ds as (
  select distinct doc_id, array_to_string(w[i:i+4], ' ') as s
  from (select doc_id, w, unnest(generate_series(1, len(w) - 4)) as i from d where len(w) >= 5)
),
bs as (
  select distinct item_id, array_to_string(w[i:i+4], ' ') as s
  from (select item_id, w, unnest(generate_series(1, len(w) - 4)) as i from b where len(w) >= 5)
),
q as (select item_id, count(*) as n_shingles from bs group by item_id),
m as (select doc_id, item_id, count(*) as n_shared from ds join bs using (s) group by doc_id, item_id)
select doc_id, item_id, n_shared, n_shingles, n_shared::double / n_shingles as containment
from m join q using (item_id) where n_shared * 1000 >= n_shingles * 800
"""

_PHRASES = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
starts as (select lang, w[i:i+4] as w from (select lang, w, unnest(generate_series(1, len(w))) as i from w)),
f as (
  select lang, k, phrase, count(*) as f
  from (select lang, k, array_to_string(w[1:k], ' ') as phrase from (select lang, w, unnest(generate_series(1, len(w))) as k from starts))
  group by all
),
n as (select lang, cast(sum(f) as bigint) as n from f where k = 1 group by lang),
candidates as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k >= 2 and f >= 100),
inside as (
  select lang, phrase, max(a) as longer
  from (
    select lang, a, array_to_string(w[i:i+m-1], ' ') as phrase
    from (select *, unnest(generate_series(1, k - m + 1)) as i from (select *, unnest(generate_series(2, k - 1)) as m from candidates where k > 2))
  )
  group by all
),
kept as (
  select c.* from candidates c left join inside using (lang, phrase) where longer is null or 100 * longer < 100 * a
),
cuts as (
  select lang, phrase, a, j, array_to_string(w[1:j], ' ') as fst, array_to_string(w[j+1:], ' ') as rst
  from (select *, unnest(generate_series(1, k - 1)) as j from kept)
),
scored as (
  select c.lang, c.phrase, c.a, c.j, fl.f as l, fr.f as r, n.n,
    cast((1000::hugeint * c.a::hugeint * n.n::hugeint) // (fl.f::hugeint * fr.f::hugeint) as bigint) as score
  from cuts c join f fl on fl.lang = c.lang and fl.phrase = c.fst
    join f fr on fr.lang = c.lang and fr.phrase = c.rst join n on n.lang = c.lang
),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1)
select lang, rank, phrase, a, l, r, n, score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest)
where rank <= 2000
"""

_ASSIGNED = """
{name} as (
  select vec_id, label, p, v, min(d * 64 + e) as best
  from (
    select parts.vec_id, parts.label, parts.p, parts.v, e,
      list_sum([(parts.v[i] - b.v[i]) * (parts.v[i] - b.v[i]) for i in range(1, len(parts.v) + 1)])::bigint as d
    from parts join {book} b on b.p = parts.p
  )
  group by all
)"""

_MOVED = """
{name} as (
  select b.p, b.e, coalesce(m.v, b.v) as v
  from {book} b left join (
    select p, e, list(x order by i) as v
    from (
      select p, e, i, ((s - ((s % n) + n) % n) // n)::bigint as x
      from (
        select p, e, i, sum(x)::bigint as s, count(*) as n
        from (select p, best % 64 as e, unnest(v) as x, unnest(range(len(v))) as i from {assigned})
        group by all
      )
    )
    group by all
  ) m on m.p = b.p and m.e = b.e
)"""

_CODES = f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as v,
    row_number() over (order by vec_id) - 1 as nth
  from embeddings where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
parts as (
  select vec_id, label, nth, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] as v
  from (select *, unnest(range(16)) as p from kept)
),
book0 as (select p, nth as e, v from parts where nth < 64),
{_ASSIGNED.format(name="assigned0", book="book0")},
{_MOVED.format(name="book1", book="book0", assigned="assigned0")},
{_ASSIGNED.format(name="assigned1", book="book1")},
{_MOVED.format(name="book2", book="book1", assigned="assigned1")},
{_ASSIGNED.format(name="assigned2", book="book2")},
digest as (
  select sha256(string_agg(x::varchar, ',' order by p, e, i)) as codebooks_sha256
  from (select p, e, unnest(v) as x, unnest(range(len(v))) as i from book2)
),
coded as (
  select vec_id, label, string_agg(printf('%02x', best % 64), '' order by p) as code, sum(best // 64)::bigint as error
  from assigned2 group by vec_id, label
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded, digest
"""

ORACLES = {
    "op2_secrets": _SECRETS,
    "op3_recompression": _REPEATS,
    "op5_warc": _WARC,
    "op9_mixing": _MIXING,
    "op10_decontamination": _CONTAINED,
    "op12_collocations": _PHRASES,
    "op13_codes": _CODES,
}
