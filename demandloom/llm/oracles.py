"""DuckDB SQL for those operators that SQL can express on whole tables."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JOIN = f"""
with recursive w as (
  select doc_id, regexp_extract_all({_LOWER}, {_WORDS}) as words from documents),
g as (
  select distinct doc_id,
         unnest(case when len(words) >= 5 then [words[i : i + 4] for i in range(1, len(words) - 3)]
                     when len(words) > 0 then [words] else [] end) as gram
  from w),
n as (select doc_id, count(*) as n from g group by doc_id),
links as (
  select a.doc_id as a, b.doc_id as b
  from g a join g b on a.gram = b.gram and a.doc_id <> b.doc_id
  join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n
  having 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach as (
  select doc_id, doc_id as other from n
  union
  select r.doc_id, l.b from reach r join links l on l.a = r.other)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(m.low, d.doc_id) as component_id
from documents d left join n on n.doc_id = d.doc_id
left join (select doc_id, min(other) as low from reach group by doc_id) m on m.doc_id = d.doc_id"""

# base 32 of a SHA-1: each five hex digits are four digits of five bits
_DIGITS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
WARC = f"""
with p as (
  select page_id, encode(coalesce(html, '')) as payload, sha1(coalesce(html, '')) as hex from pages),
d as (
  select page_id, octet_length(payload) as payload_bytes, hex,
         list_aggregate([substr({_DIGITS}, cast((cast('0x' || substr(hex, 1 + 5 * (i // 4), 5) as bigint)
           >> (15 - 5 * (i % 4))) & 31 as bigint) + 1, 1) for i in range(0, 32)], 'string_agg', '') as payload_digest,
         max(page_id) over (partition by payload) as last
  from p)
select page_id, payload_bytes, payload_digest,
       case when page_id < last then 'revisit' else 'response' end as record_type,
       case when page_id < last then last end as refers_to, true as intact
from d"""

TOP_K = """
with v as (
  select vec_id, [floor(256 * cast(x as double)) for x in embedding] as terms from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.terms, c.terms) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
       vec_id, score
from s qualify rank <= 5"""

COLLOCATIONS = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
f as (
  select lang, array_to_string(p, ' ') as phrase, len(p) as words, count(*) as f
  from (select lang, unnest(list_concat([w[i : i] for i in range(1, len(w) + 1)],
                 [w[i : i + 1] for i in range(1, len(w))], [w[i : i + 2] for i in range(1, len(w) - 1)])) as p from words)
  group by lang, phrase, words),
total as (select lang, cast(sum(f) as bigint) as n from f where words = 1 group by lang),
c as (select lang, phrase, words, f as a, string_split(phrase, ' ') as w from f where words >= 2 and f >= 10),
cuts as (select *, unnest(range(1, words)) as k from c),
scored as (
  select cuts.lang, cuts.phrase, cuts.a, k, x.f as l, y.f as r,
         cast((1000000::hugeint * a * a) // (x.f::hugeint * y.f) as bigint) as score
  from cuts
  join f x on x.lang = cuts.lang and x.phrase = array_to_string(w[1 : k], ' ')
  join f y on y.lang = cuts.lang and y.phrase = array_to_string(w[k + 1 :], ' ')
  qualify row_number() over (partition by cuts.lang, cuts.phrase order by score, k) = 1),
held as (
  select lang, phrase, max(a) as held
  from (select lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) as phrase
        from c where words = 3)
  group by lang, phrase),
kept as (
  select scored.* from scored left join held using (lang, phrase) where held is null or 100 * held < 50 * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join total using (lang) qualify rank <= 2000"""

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": NGRAM_JOIN,
    "op2_warc": WARC,
    "op9_exact_topk": TOP_K,
    "op12_collocations": COLLOCATIONS,
}
