"""SQL counterparts for DuckDB, for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

_DECONTAMINATE = f"""
with dw as (select doc_id, {_WORDS} w from documents),
iw as (select item_id, {_WORDS} w from benchmark),
it as (
  select item_id, w, least(10, len(w)) size, unnest(range(1, len(w) - least(10, len(w)) + 2)) p
  from iw where len(w) > 0
),
ig as (select distinct item_id, size, array_to_string(w[p:p + size - 1], ' ') g from it),
grams as (select distinct size, g from ig),
dp as (
  select doc_id, w, size, unnest(range(1, len(w) - size + 2)) p
  from dw, (select distinct size from ig) where len(w) >= size
),
hit as (select doc_id, p, size, g from (select doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') g from dp) join grams using (size, g)),
hw as (select doc_id, count(distinct q) n_hit from (select doc_id, unnest(range(p, p + size)) q from hit) group by 1),
hi as (
  select doc_id, count(*) n_items, string_agg(i, ',' order by i) ids
  from (select distinct doc_id, cast(item_id as varchar) i from hit join ig using (size, g)) group by 1
)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from dw left join hw using (doc_id) left join hi using (doc_id)
"""

_WARC = """
with p as (select page_id, coalesce(html, '') html, cast(strlen(coalesce(html, '')) as bigint) payload_bytes from pages),
f as (select html, max(page_id) first_id from p where payload_bytes >= 1000 group by html)
select page_id, payload_bytes, sha1(html) payload_digest,
  case when first_id is not null and first_id is distinct from page_id then 'revisit' else 'response' end record_type,
  case when first_id is not null and first_id is distinct from page_id then first_id end refers_to
from p left join f using (html)
"""

_SUFFIXES = """
with b as (select doc_id, encode(coalesce(text, '')) t from documents),
w as (select doc_id, p, t[p:p + 49] s from (select doc_id, t, unnest(range(1, octet_length(t) - 48)) p from b where octet_length(t) >= 50)),
f as (select s, min(doc_id) first_id from w group by s),
g as (select w.doc_id, w.p from w join f using (s) where f.first_id < w.doc_id),
q as (select *, max(p + 49) over (partition by doc_id order by p rows between unbounded preceding and 1 preceding) before from g),
r as (select *, sum(case when before >= p - 1 then 0 else 1 end) over (partition by doc_id order by p) run from q),
u as (select doc_id, run, min(p) a, max(p) + 49 z from r group by 1, 2),
c as (select doc_id, sum(z - a + 1) n_removed, count(*) n_spans from u group by 1),
k as (select doc_id, a, z, coalesce(lag(z) over (partition by doc_id order by a), 0) from_z from u),
x as (
  select k.doc_id, string_agg(hex(b.t[from_z + 1:a - 1]), '' order by a) head, max(z) last_z
  from k join b using (doc_id) group by 1
)
select b.doc_id, cast(octet_length(t) as bigint) n_bytes, cast(coalesce(n_removed, 0) as bigint) n_removed,
  coalesce(n_spans, 0) n_spans,
  sha256(case when x.doc_id is null then t else unhex(head || hex(t[last_z + 1:octet_length(t)])) end) kept_sha256
from b left join c using (doc_id) left join x using (doc_id)
"""

_LINE_RUNS = r"""
with t as (select doc_id, string_split(coalesce(text, ''), chr(10)) l from documents),
l as (select doc_id d, unnest(range(len(l))) n, unnest(l) line from t),
w as (select d, n, line, len(regexp_extract_all(line, '[^\x09-\x0D\x20]+')) words, count(*) over (partition by line) k from l),
m as (
  select b.d, b.n, b.words, a.d e, b.n - a.n diagonal
  from w a join w b on a.line = b.line and (a.d < b.d or (a.d = b.d and a.n < b.n))
  where a.k > 1
),
i as (select *, n - row_number() over (partition by d, e, diagonal order by n) part from m),
s as (select *, sum(words) over (partition by d, e, diagonal, part) size from i),
g as (select distinct d, n from s where size >= 50),
r as (select d, n, n - row_number() over (partition by d order by n) part from g),
c as (select d, count(*) n_removed, count(distinct part) n_runs from r group by d),
k as (select l.d, string_agg(line, chr(10) order by l.n) kept from l left join g using (d, n) where g.d is null group by l.d)
select t.doc_id, cast(len(l) as bigint) n_lines, coalesce(n_removed, 0) n_removed, coalesce(n_runs, 0) n_runs,
  sha256(coalesce(kept, '')) kept_sha256
from t left join c on c.d = t.doc_id left join k on k.d = t.doc_id
"""

_HARD_NEGATIVES = """
with r as (
  select vec_id id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) v
  from embeddings
  where label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select a.id anchor, b.id other, a.l = b.l same, cast(list_dot_product(a.v, b.v) as bigint) score
  from r a join r b on a.id <> b.id and len(a.v) = len(b.v) where a.id % 100 = 0
),
p as (select * from s where same qualify row_number() over (partition by anchor order by score desc, other) <= 5),
n as (
  select p.anchor anchor_id, p.other positive_id, s.other negative_id, p.score positive_score, s.score negative_score,
    row_number() over (partition by p.anchor, p.other order by s.score desc, s.other) rank
  from p join s on p.anchor = s.anchor and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score
)
select anchor_id, positive_id, cast(rank as integer) rank, negative_id, positive_score, negative_score from n where rank <= 5
"""

_NGRAM_JOIN = f"""
with recursive w as (select doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+'), []) w from documents),
g as (
  select distinct doc_id, array_to_string(w[p:p + 4], ' ') g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) p from w where len(w) > 0)
),
c as (select doc_id, count(*) n from g group by 1),
o as (select a.doc_id a, b.doc_id b, count(*) shared from g a join g b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select a, b from o join c x on x.doc_id = a join c y on y.doc_id = b where 100 * shared >= 80 * (x.n + y.n - shared)),
ends as (select a, b from e union all select b, a from e),
reach as (select a doc, a root from ends union select ends.b, reach.root from reach join ends on reach.doc = ends.a),
least as (select doc, min(root) root from reach group by 1)
select w.doc_id, coalesce(n, 0) n_shingles, coalesce(root, w.doc_id) component_id
from w left join c using (doc_id) left join least on doc = w.doc_id
"""

_SPELLINGS = r"""
with recursive t(i, k, c) as (
  select range, 0, cast(range as ubigint) from range(256)
  union all select i, k + 1, case when c & 1 = 1 then xor(c >> 1, cast(3988292384 as ubigint)) else c >> 1 end from t where k < 8
),
crcs as (select list(c order by i) tab from t where k = 8),
occ as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') run
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) run from documents)
),
runs as (select doc_id, run, count(*) n, hex(encode(concat(doc_id, ':', run))) h from occ where length(run) >= 6 group by 1, 2),
coded as (
  select run, n, xor(list_reduce(
    list_prepend(cast(4294967295 as ubigint), list_transform(range(length(h) // 2), lambda i: cast(concat('0x', substr(h, 2 * i + 1, 2)) as ubigint))),
    lambda c, b: xor(c >> 8, tab[cast(xor(c, b) & 255 as integer) + 1])), cast(4294967295 as ubigint)) code
  from runs, crcs
),
words as (
  select word, cast(sum(n) as bigint) n from (
    select case when code % 199 = 0 then concat(substr(run, 1, cast(code % length(run) as bigint)), substr(run, cast(code % length(run) as bigint) + 2))
      else run end word, n from coded)
  where length(word) >= 6 group by 1 having sum(n) >= 5
),
cut as (
  select word, i, concat(substr(word, 1, i - 1), '*', substr(word, i + 1)) masked, concat(substr(word, 1, i - 1), substr(word, i + 1)) short
  from (select word, unnest(range(1, length(word) + 1)) i from words)
),
met as (
  select a.word, b.word other from cut a join cut b on a.masked = b.masked and a.word <> b.word
  union select word, short from cut where short in (select word from words)
  union select short, word from cut where short in (select word from words)
),
near as (
  select met.word, other, b.n other_n, count(*) over (partition by met.word) n_near
  from met join words b on b.word = other
  qualify row_number() over (partition by met.word order by b.n desc, other) = 1
),
linked as (
  select w.word, case when other_n >= 5 * n then other end form, n, coalesce(n_near, 0) n_near, case when other_n >= 5 * n then other_n end form_n
  from words w left join near using (word)
),
chain(word, place, step) as (
  select word, form, 1 from linked where form is not null
  union all select chain.word, form, step + 1 from chain join linked on linked.word = chain.place where form is not null
),
roots as (select word, arg_max(place, step) root from chain group by 1)
select word, form, coalesce(root, word) root, n, n_near, form_n from linked left join roots using (word)
"""

ORACLES: dict[str, str] = {
    "op3_decontaminate": _DECONTAMINATE,
    "op7_warc": _WARC,
    "op8_suffix_levels": _SUFFIXES,
    "op10_line_runs": _LINE_RUNS,
    "op11_hard_negatives": _HARD_NEGATIVES,
    "op12_ngram_join": _NGRAM_JOIN,
    "op13_spellings": _SPELLINGS,
}
