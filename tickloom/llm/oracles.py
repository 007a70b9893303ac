"""DuckDB SQL for the training-data queries that SQL can express."""

TOP_K = """
with v as (
  select vec_id, min(q) as v from (
    select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as q
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)
  group by vec_id),
scores as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
where rank <= 10
"""

LINE_DEDUP = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines),
firsts as (
  select key, min(doc_id) as first_id from keyed where length(key) >= 10 group by key)
select doc_id, count(*) as n_lines, count(*) filter (first_id < doc_id) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos)
    filter (first_id is null or first_id >= doc_id), '')) as kept_sha256
from keyed left join firsts using (key)
group by doc_id
"""

WARC = """
with payloads as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages),
firsts as (
  select payload_digest, min(page_id) as first from payloads where payload_bytes >= 100 group by 1)
select page_id, payload_bytes, payload_digest,
  case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
  case when first <> page_id then first end as refers_to
from payloads left join firsts using (payload_digest)
"""

DIVERGENCE = r"""
with docs as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
terms as (
  select row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from docs),
kept as (
  select lang, term, count(*) as lang_n from terms group by lang, term having count(distinct row) >= 3),
langs as (select lang, count(*) as v, sum(lang_n) as lang_total from kept group by lang),
counts as (select lang, source, term, count(*) as n from terms semi join kept using (lang, term) group by all),
totals as (select lang, source, sum(n) as total from counts group by all),
sources as (
  select distinct lang, source, coalesce(total, 0) as total from docs left join totals using (lang, source)),
cells as (
  select lang, s.source, term, coalesce(n, 0) as n, lang_n,
    1 + (1000000000 * (coalesce(n, 0) + 1)::hugeint) // (s.total + v)::hugeint as p,
    1 + (1000000000 * (lang_n + 1)::hugeint) // (lang_total + v)::hugeint as q
  from sources s join kept using (lang) join langs using (lang) left join counts using (lang, source, term)),
pair_sums as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from cells a join cells b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from sources a join sources b on a.lang = b.lang and a.source <> b.source
    left join pair_sums x on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all
  select lang, source, 'term', term, (p - q) * (p - q) // q from cells where n > 0 and p > q)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from (select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from found)
where part = 'pair' or rank <= 200
"""

REPEATS = """
with docs as (
  select row_number() over () as row, doc_id, encode(coalesce(text, '')) as raw from documents),
starts as (select row, raw, unnest(range(octet_length(raw) - 399)) as i from docs),
windows as (select row, i, md5(array_slice(raw, i + 1, i + 400)) as content from starts),
repeated as (select row, i from (select row, i, count(*) over (partition by content) as n from windows) where n > 1),
marked as (
  select row, i, case when i <= lag(i) over (partition by row order by i) + 400 then 0 else 1 end as new from repeated),
spans as (
  select row, min(i) as a, max(i) + 400 as b
  from (select row, i, sum(new) over (partition by row order by i) as span from marked) group by row, span),
gaps as (
  select row, b as a, lead(a) over (partition by row order by a) as b from spans
  union all select row, 0, min(a) from spans group by row
  union all select row, 0, null from docs where row not in (select row from spans)),
kept as (
  select row, string_agg(hex(array_slice(raw, a + 1, coalesce(b, octet_length(raw)))), '' order by a) as hex
  from gaps join docs using (row) group by row),
removed as (select row, sum(b - a) as n, count(*) as spans from spans group by row)
select doc_id, cast(octet_length(raw) as bigint) as n_bytes, cast(coalesce(n, 0) as bigint) as n_removed,
  coalesce(spans, 0) as n_spans, sha256(unhex(coalesce(hex, ''))) as kept_sha256
from docs left join removed using (row) left join kept using (row)
"""


def llm_oracles() -> dict[str, str]:
    return {"op1_vector_file": TOP_K, "op2_line_dedup": LINE_DEDUP, "op8_warc": WARC, "op11_source_divergence": DIVERGENCE,
            "op13_suffix_dedup": REPEATS}
