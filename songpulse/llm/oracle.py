"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP9 = rf"""
with d as (
  select doc_id, source, cast(len({_WORDS}) as bigint) as size,
    (cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null') || ':mix-1'), 1, 13) as bigint) + 0.5::double)
      / 4503599627370496.0::double as u,
    case when coalesce(text, '') = '' then 1.0::double else 1.0::double
      + length(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]+', '', 'g'))::double / length(text)::double end as w
  from documents),
v as (select *, pow(u, 1.0::double / w) as v from d),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
s1 as (select *, [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as bigint)] as weight,
    (source_size * 2)::double as cap from s),
s2 as (select *, (sum(source_size) over ())::double * 1.5::double as total, sum(weight) over () as weights from s1),
s3 as (select *, row_number() over f as ord,
    (total - coalesce(sum(cap) over (f rows between unbounded preceding and 1 preceding), 0))
      / (weights - coalesce(sum(weight) over (f rows between unbounded preceding and 1 preceding), 0))::double as level
  from s2 window f as (order by cap / weight, source nulls last)),
s4 as (select *, cap <= weight * level as capped from s3),
s5 as (select source, source_size, case when capped then cap
    else weight * (select arg_min(level, ord) from s4 where not capped) end::double as target from s4),
s6 as (select *, case when source_size = 0 then 0 else floor(target / source_size) end::bigint as epochs from s5),
o as (select v.doc_id, v.size, s6.source_size, s6.target, s6.epochs,
    coalesce(sum(v.size) over (partition by v.source order by v.v desc, v.doc_id nulls last, v.size
      rows between unbounded preceding and 1 preceding), 0) as ahead
  from v join s6 on v.source is not distinct from s6.source)
select doc_id, size, source_size, target, cast(size * (epochs
  + case when 2 * ahead + size <= 2 * (target - epochs * source_size) then 1 else 0 end) as bigint) as taken
from o
"""

OP10 = rf"""
with d as (select doc_id, row_number() over () as rid, coalesce(text, '') as text, {_WORDS} as ws from documents),
win as (select rid, i, array_to_string(ws[i : i + 7], ' ') as win
  from (select rid, ws, unnest(generate_series(1, len(ws) - 7)) as i from d where len(ws) >= 8)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, win) as n from win) where n > 1),
cov as (select rid, cast(count(distinct i + k) as bigint) as n
  from rep, (select unnest(generate_series(0, 7)) as k) group by rid),
ls as (select rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from d),
m as (select doc_id, cast(len(ws) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, coalesce(n, 0) as n_repeat_words,
    len(l) as n_lines, length(regexp_replace(text, '[^A-Z]+', '', 'g')) as n_upper,
    length(regexp_replace(text, '[^!]+', '', 'g')) as n_exclaims,
    2 * length(regexp_replace(text, '[^\p{{Han}}\p{{Hiragana}}\p{{Katakana}}\p{{Thai}}\p{{Lao}}\p{{Khmer}}\p{{Myanmar}}]+', '', 'g'))
      > length(regexp_replace(text, '[^\p{{L}}\p{{M}}]+', '', 'g')) as unspaced
  from d join ls using (rid) left join cov using (rid)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    case when n_words < 20 then 1 else 0 end + case when 100 * n_repeat_words > 30 * n_words then 2 else 0 end
    + case when 100 * n_symbols > 30 * n_words then 4 else 0 end
    + case when 100 * n_dup_lines > 50 * n_lines then 8 else 0 end
    + case when word_chars < 2 * n_words or word_chars > 20 * n_words then 16 else 0 end
    + case when 100 * n_upper > 50 * word_chars then 32 else 0 end
    + case when 100 * n_exclaims > 50 * n_words then 64 else 0 end
    + case when word_chars < 2 * n_words or word_chars > 20 * n_words and not unspaced then 128 else 0 end as bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words,
  cast(bits as bigint) as fail_bits, base_failed, bits & ~16 = 0 as kept from b
"""

OP3 = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (select *, length(text) + length(regexp_replace(text, '[^<>\\]', '', 'g'))
  + length(role) + length(regexp_replace(role, '[^<>\\]', '', 'g')) + 15 as n from c),
o as (select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
    coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss, sum(n) as n
  from e group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, cast(length(loss) as bigint) as loss_chars, sha256(loss) as loss_sha256,
  cast(n as bigint) as formatted_chars from o
"""

OP5 = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as ws from documents),
sh as (select distinct doc_id, array_to_string(ws[i : i + 3], ' ') as s
  from (select doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 3, 1))) as i from d where len(ws) > 0)),
n as (select doc_id, count(*) as n from sh group by doc_id),
common as (select x.doc_id as a, y.doc_id as b, count(*) as c from sh x join sh y on x.s = y.s and x.doc_id != y.doc_id group by all),
links as (select a, b from common join n na on a = na.doc_id join n nb on b = nb.doc_id where 100 * c >= 80 * (na.n + nb.n - c)),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
least as (select a, min(b) as least from reach group by a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(least, d.doc_id)) as component_id,
  d.doc_id = least(d.doc_id, coalesce(least, d.doc_id)) as kept
from d left join n using (doc_id) left join least on a = d.doc_id
"""

_VECTORS = """select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""

OP11 = rf"""
with v as ({_VECTORS}),
s as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id != c.vec_id and len(q.v) = len(c.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
"""

OP12 = rf"""
with u as ({_VECTORS} and label is not null),
v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, v from u),
s as (select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_inner_product(a.v, c.v) as bigint) as score
  from v a join v c on a.vec_id % 100 = 0 and a.vec_id != c.vec_id and len(a.v) = len(c.v)),
p as (select anchor_id, vec_id as positive_id, score as positive_score,
  row_number() over (partition by anchor_id order by score desc, vec_id) as n from s where same),
w as (select p.anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score,
  row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as rank
  from p join s on p.anchor_id = s.anchor_id and p.n <= 5 and not s.same
    and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from w where rank <= 5
"""

OP13 = r"""
with d as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
t as (select id, lang, source, unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term, count(*) as n from t group by all having count(distinct id) >= 10),
v as (select lang, count(*) as v, sum(n) as n from kept group by lang),
grp as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from t join kept using (lang, term) group by all),
tot as (select lang, source, sum(n) as n from c group by all),
cell as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (coalesce(tot.n, 0) + 2 * v.v) as p,
    1 + (1000000000::hugeint * (k.n + 2)) // (v.n + 2 * v.v) as q
  from grp g join kept k using (lang) join v using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term
    left join tot on tot.lang = g.lang and tot.source = g.source),
pv as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from cell a join cell b on a.lang = b.lang and a.term = b.term and a.source != b.source group by all),
part as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(pv.value, 0) as value
  from grp a join grp b on a.lang = b.lang and a.source != b.source
    left join pv on pv.lang = a.lang and pv.source = a.source and pv.item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) from cell where n > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from part)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from r where part = 'pair' or rank <= 10
"""

ORACLE: dict[str, str] = {
    "op3_format_chats": OP3,
    "op5_minhash_dedup": OP5,
    "op9_mix_sources": OP9,
    "op10_quality_ledger": OP10,
    "op11_top_products": OP11,
    "op12_hard_negatives": OP12,
    "op13_source_divergence": OP13,
}
