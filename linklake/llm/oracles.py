"""DuckDB SQL for the queries of this package that SQL can express.

Learned verdicts (op3, op7), tokenizers (op1, op6, op10), markup (op2), CRC-32 features (op11),
rewritten texts (op12) and the pipeline have none; their tests use brute-force versions.
"""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"

WARC = """
with p as (
  select page_id, encode(coalesce(html, '')) as payload from pages
), d as (
  select page_id, octet_length(payload) as payload_bytes, sha256(payload) as payload_digest from p
), f as (
  select *, min(page_id) over (partition by payload_digest) as first_page from d
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes < 100 or page_id = first_page then 'response' else 'revisit' end as record_type,
  case when payload_bytes < 100 or page_id = first_page then null else first_page end as refers_to
from f
"""

TOP_K = """
with v as (
  select vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as vector
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum([a[1] * a[2] for a in list_zip(q.vector, c.vector)]) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 5
"""

JACCARD = f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}) as words
  from documents
), s as (
  select distinct doc_id, array_to_string(words[i:i + 4], ' ') as shingle
  from w, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as t(i)
  where len(words) > 0
), n as (
  select doc_id, count(*) as n from s group by doc_id
), c as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id
  group by all
), links as (
  select a, b from c join n na on na.doc_id = a join n nb on nb.doc_id = b
  where 100 * common >= 75 * (na.n + nb.n - common)
), ways as (
  select a, b from links union all select b, a from links
), reach(doc_id, other) as (
  select doc_id, doc_id from w
  union
  select reach.doc_id, ways.b from reach join ways on reach.other = ways.a
)
select w.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(reach.other) as component_id
from w join reach using (doc_id) left join n using (doc_id) group by w.doc_id
"""

SUBSTRINGS = f"""
with t as (
  select doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) as words from documents
), p as (
  select doc_id, i, array_to_string(words[i:i + 34], ' ') as run
  from t, unnest(range(1, len(words) - 33)) as u(i) where len(words) >= 35
), again as (
  select run from p group by run having count(*) > 1
), starts as (
  select distinct doc_id, i from p join again using (run)
), places as (
  select t.doc_id, i, words[i] as word, s.i is not null as starts_here
  from t cross join unnest(range(1, len(words) + 1)) as u(i) left join starts s using (doc_id, i)
), marked as (
  select *, bool_or(starts_here) over (partition by doc_id order by i rows between 34 preceding and current row) as gone from places
), cut as (
  select doc_id, count_if(gone) as n_removed, string_agg(word, ' ' order by i) filter (where not gone) as kept from marked group by doc_id
)
select t.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from t left join cut using (doc_id)
"""

AUDIT = f"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents
), w as (
  select *, regexp_extract_all(text, {_WORD}) as words, min(doc_id) over (partition by text) as least from d
), f as (
  select doc_id, part,
    cast(len(words) < 100 as int) + 2 * cast(100 * len(list_distinct(words)) < 80 * len(words) as int)
    + 4 * cast(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) as int)
    + 8 * cast(regexp_matches(text, '[#$%&*|]') as int) + 16 * cast(coalesce(doc_id > least, false) as int) as mask
  from w
), l as (
  select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
  from labels where doc_id is not null group by doc_id
), c as (
  select part, mask, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n
  from f left join l using (doc_id) group by all
), x as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as letter, unnest([1, 2, 4, 8, 16]) as bit
), o as (
  select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from x a, x b, x c, x d, x e where a.bit + b.bit + c.bit + d.bit + e.bit = 31
    and len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), s as (
  select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0) as before from o, unnest(range(1, 6)) as t(step)
), r as (
  select part, filter_order, step, n, good, toxic, mask, bit, mask & bit <> 0 as fails, mask & cast(before as int) <> 0 as gone from c, s
)
select part, filter_order, cast(step as int) as step,
  cast(sum(case when not fails and not gone then n else 0 end) as bigint) as kept,
  cast(sum(case when fails and not gone then n else 0 end) as bigint) as removed,
  cast(sum(case when fails and gone then n else 0 end) as bigint) as redundant,
  cast(sum(case when mask = bit then n else 0 end) as bigint) as unique_fails,
  cast(sum(case when fails and not gone and good then n else 0 end) as bigint) as good_lost,
  cast(sum(case when fails and not gone and toxic then n else 0 end) as bigint) as toxic_lost,
  cast(sum(sum(case when fails and not gone then n else 0 end)) over (partition by part, bit) as bigint) as shapley
from r group by part, filter_order, step, bit
"""

ORACLES = {
    "op4_warc_dictionary": WARC,
    "op5_mtree_top_k": TOP_K,
    "op8_ngram_jaccard": JACCARD,
    "op9_substring_dedup": SUBSTRINGS,
    "op13_filter_audit": AUDIT,
}
