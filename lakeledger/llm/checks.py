"""SQL for the queries whose contract SQL can express."""

#: Words in order, windows of 50 of them as text, and whether a window stands in an earlier document.
PASSAGES = r"""with d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents where doc_id is not null),
t as (select doc_id, unnest(w) as word, unnest(range(len(w))) as p, len(w) as n from d),
win as (select doc_id, p, n, word, case when p + 50 <= n then string_agg(word, ' ') over (partition by doc_id order by p rows between current row and 49 following) end as x from t),
flag as (select *, coalesce(min(doc_id) over (partition by x) < doc_id and x is not null, false) as f from win),
cover as (select *, max(f) over (partition by doc_id order by p rows between 49 preceding and current row) as gone from flag),
out as (select doc_id, count(*) as n_words, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by p) filter (not gone) as kept from cover group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join out using (doc_id)"""

#: Strings of 100 bytes by their digest; those that are not the first of their kind cover spans, which are taken out.
STRINGS = """with d as (select doc_id, encode(coalesce(text, '')) as x, octet_length(encode(coalesce(text, ''))) as n from documents where doc_id is not null),
win as (select doc_id, p, md5_number(x[p + 1:p + 100]) as h from (select doc_id, x, unnest(range(n - 99)) as p from d)),
late as (select doc_id, p from win join (select h, min(doc_id * 1000000000 + p) as f from win group by 1 having count(*) > 1) using (h) where doc_id * 1000000000 + p > f),
island as (select doc_id, p, sum(new) over (partition by doc_id order by p) as i from (select *, case when p <= lag(p) over (partition by doc_id order by p) + 100 then 0 else 1 end as new from late)),
span as (select doc_id, min(p) as a, max(p) + 100 as b from island group by doc_id, i),
rest as (select doc_id, lag(b, 1, 0) over (partition by doc_id order by a) as a, a as b, b as upto from span),
out as (select r.doc_id, count(*) as n_spans, sum(r.upto - r.b) as n_removed, string_agg(hex(x[r.a + 1:r.b]), '' order by r.a) || hex(any_value(x)[max(r.upto) + 1:any_value(n)]) as kept
  from rest r join d using (doc_id) group by 1)
select d.doc_id, n as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, hex(x)))) as kept_sha256 from d left join out using (doc_id)"""

#: All pairs of vectors at a cosine of 0.9 and more, and the least id that links reach.
LINKS = """with recursive good as (select vec_id, cast(embedding as double[]) as v, sqrt(list_inner_product(cast(embedding as double[]), cast(embedding as double[]))) as n from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
link as (select a.vec_id as a, b.vec_id as b from good a join good b on a.vec_id <> b.vec_id and list_inner_product(a.v, b.v) >= 0.9 * a.n * b.n),
reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join link l on l.a = r.b),
number as (select a, count(*) as n from link group by 1)
select e.vec_id, coalesce(n, 0) as n_links, c as component_id, e.vec_id = c as kept from embeddings e join (select a, min(b) as c from reach group by 1) r on r.a = e.vec_id left join number on number.a = e.vec_id"""

#: The response of a payload is the record with the largest page_id.
RECORDS = """with p as (select page_id, encode(coalesce(html, '')) as x from pages where page_id is not null),
q as (select page_id, octet_length(x) as n, sha1(x) as d, max(page_id) over (partition by x) as holder from p)
select page_id, n as payload_bytes, d as payload_digest, case when n >= 1000 and holder <> page_id then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and holder <> page_id then holder end as refers_to from q"""


def crc(text: str) -> str:
    """CRC-32 of an ASCII text, as an expression: one step of the polynomial for each bit."""
    return f"""xor(4294967295::ubigint, list_reduce(list_concat([4294967295::ubigint], list_transform(string_split({text}, ''), lambda c: ord(c)::ubigint)),
  lambda a, b: list_reduce(list_concat([xor(a, b)], [0::ubigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end)))::bigint"""


#: Words at three multiples of a lag propose it for a document; all stretches that agree over such a lag; those inside
#: one of a smaller lag do not have this as their smallest period.
RUNS = rf"""with d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w, {crc("doc_id::varchar")} as h from documents where doc_id is not null),
g as (select *, len(w) as n, h // 10 as g, case when len(w) > 0 then (h // 10) % len(w) end as a from d),
p as (select *, case when h % 10 = 0 and n > 0 then 1 + (n - a) // (3 + g % 8) end as p from g),
t as materialized (select doc_id, n, i, w[1 + case when i >= a and p is not null then a + (i - a) % p else i end] as x from (select *, unnest(range(n)) as i from p)),
lag as (select doc_id, n, unnest(range(1, n // 4 + 1)) as q from p),
step as (select doc_id, q, unnest(range(n // q)) * q as i from lag),
word as materialized (select s.doc_id, s.q, s.i, t.x from step s join t using (doc_id, i)),
cand as materialized (select distinct doc_id, q from (select doc_id, q, x, lead(x) over v as y, lead(x, 2) over v as z from word window v as (partition by doc_id, q order by i)) where x = y and y = z),
pair as materialized (select c.doc_id, c.q, t.i, t.x, t.i + c.q as upto from cand c join t using (doc_id)),
same as (select p.doc_id, p.q, p.i from pair p join t on t.doc_id = p.doc_id and t.i = p.upto and t.x = p.x),
stretch as (select doc_id, q, min(i) as s, count(*) + q as l from (select *, i - row_number() over (partition by doc_id, q order by i) as k from same) group by doc_id, q, k having count(*) + q >= greatest(6, 4 * q)),
run as (select * from stretch a where not exists (select 1 from stretch b where b.doc_id = a.doc_id and b.q < a.q and b.s <= a.s and b.s + b.l >= a.s + a.l)),
best as (select * from run qualify row_number() over (partition by doc_id order by l / q desc, s, q) = 1),
listed as (select doc_id, count(*) as n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' order by s, q) as r from run group by 1),
gone as (select distinct doc_id, unnest(range(s + q, s + l)) as i from run),
rest as (select t.doc_id, string_agg(x, ' ' order by t.i) as kept from t left join gone using (doc_id, i) where gone.i is null group by 1)
select d.doc_id, coalesce(n_runs, 0) as n_runs, s as start, l as length, q as period, 1000 * l // q as exponent_milli, sha256(coalesce(r, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
from d left join listed using (doc_id) left join best using (doc_id) left join rest using (doc_id)"""

#: Backwards over the rows of all conversations at once: for each state the cheapest (cost, audit, repaired text) from a
#: row on. Of two ways with the same next letter and state the rest decides, so the least (cost, audit) is kept whole.
REPAIRS = rf"""with recursive raw as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as k from conversations),
rows as (select conv_id, turn, case when k = 4 then 'user' else role end as role, case when k = 1 then '' when k = 2 then translate(text, '.!?', '') else text end as text, unnest(range(case k when 0 then 0 when 3 then 2 else 1 end)) as copy from raw),
seen as (select *, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as last, row_number() over w as i, row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as nth, lag(role[1]) over w as before
  from rows window w as (partition by conv_id order by turn nulls first, role, md5(text), copy)),
fault as (select *, case when last = '' then 1 when nth > 1 then 2 when last not in ('.', '!', '?') then 3 else 0 end as f from seen),
n as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (f = 1) as blank, count(*) filter (f = 2) as duplicate, count(*) filter (f = 3) as truncated,
  count(*) filter (before is not null and before || role[1] not in ('su', 'ua', 'au')) as illegal from fault group by 1),
way as (select conv_id, n as i, [struct_pack(c := 0, a := '', t := ''), struct_pack(c := 4, a := 'II', t := 'user:' || chr(10) || 'assistant:' || chr(10)), struct_pack(c := 2, a := 'I', t := 'assistant:' || chr(10)), struct_pack(c := 0, a := '', t := '')] as v from n
  union all select conv_id, i - 1, [w0, w1, w2, w3] from (select conv_id, i,
    list_min([b0, struct_pack(c := b2.c + 2, a := 'I' || b2.a, t := u || b2.t), struct_pack(c := b3.c + 4, a := 'II' || b3.a, t := u || s || b3.t)]) as w0,
    list_min([b1, struct_pack(c := b2.c + 2, a := 'I' || b2.a, t := u || b2.t), struct_pack(c := b3.c + 4, a := 'II' || b3.a, t := u || s || b3.t)]) as w1,
    list_min([b2, struct_pack(c := b3.c + 2, a := 'I' || b3.a, t := s || b3.t)]) as w2, list_min([b3, struct_pack(c := b2.c + 2, a := 'I' || b2.a, t := u || b2.t)]) as w3
  from (select w.conv_id, w.i, 'user:' || chr(10) as u, 'assistant:' || chr(10) as s,
    list_min([struct_pack(c := v[1].c + 3, a := 'D' || v[1].a, t := v[1].t), struct_pack(c := v[3].c + 2 + e, a := 'R' || v[3].a, t := 'user:' || x || v[3].t),
      struct_pack(c := (case r when 's' then v[2].c when 'u' then v[3].c else 1000000000 end) + e, a := 'K' || (case r when 's' then v[2].a else v[3].a end), t := role || ':' || x || (case r when 's' then v[2].t else v[3].t end))]) as b0,
    list_min([struct_pack(c := v[2].c + 3, a := 'D' || v[2].a, t := v[2].t), struct_pack(c := v[3].c + 2 + e, a := 'R' || v[3].a, t := 'user:' || x || v[3].t),
      struct_pack(c := (case r when 'u' then v[3].c else 1000000000 end) + e, a := 'K' || v[3].a, t := role || ':' || x || v[3].t)]) as b1,
    list_min([struct_pack(c := v[3].c + 3, a := 'D' || v[3].a, t := v[3].t), struct_pack(c := v[4].c + 2 + e, a := 'R' || v[4].a, t := 'assistant:' || x || v[4].t),
      struct_pack(c := (case r when 'a' then v[4].c else 1000000000 end) + e, a := 'K' || v[4].a, t := role || ':' || x || v[4].t)]) as b2,
    list_min([struct_pack(c := v[4].c + 3, a := 'D' || v[4].a, t := v[4].t), struct_pack(c := v[3].c + 2 + e, a := 'R' || v[3].a, t := 'user:' || x || v[3].t),
      struct_pack(c := (case r when 'u' then v[3].c else 1000000000 end) + e, a := 'K' || v[3].a, t := role || ':' || x || v[3].t)]) as b3
  from way w join (select *, role[1] as r, text || chr(10) as x, case f when 0 then 0 when 3 then 1 else 1000000000 end as e from fault) q on q.conv_id is not distinct from w.conv_id and q.i = w.i))),
best as (select n.*, v[1] as v from way join n on n.conv_id is not distinct from way.conv_id where i = 0)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  cast(coalesce(v.c, 0) as bigint) as cost, coalesce(v.a, '') as audit, sha256(coalesce(v.t[:-2], '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join best b on b.conv_id is not distinct from c.conv_id"""

#: Terms of the band, their subsets, and a hash for each subset that a text has a term in.
PRINTS = r"""with d as materialized (select doc_id, coalesce(text, '') as x, length(coalesce(text, '')) as n from documents where doc_id is not null),
nx as (select *, coalesce(lead(x) over w, first_value(x) over w) as y, coalesce(lead(doc_id) over w, first_value(doc_id) over w) as next_id from d window w as (order by doc_id, sha256(x))),
e as materialized (select *, x[:n - n // 2] || y[:n // 2] as z from nx),
t as materialized (select doc_id, 0 as which, unnest(list_distinct(list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda v: v <> ''))) as term from e
  union all select doc_id, 1, unnest(list_distinct(list_filter(string_split_regex(z, '[\x20\x09-\x0D]+'), lambda v: v <> ''))) from e),
lex as materialized (select term from t where which = 0 group by 1 having count(*) * 2000 >= (select count(*) from d) and count(*) * 50 <= (select count(*) from d)),
sub as materialized (select term, k from lex, range(33) r(k) where k = 0 or ('0x' || substr(md5(term), 1, 8))::bigint // (1 << (8 * ((k - 1) // 8))::int) % (1 << ((k - 1) % 8 + 1)::int) = 0),
piece as materialized (select doc_id, which, k, substr(md5(string_agg(term, ' ' order by term)), 1, 8) as h from t join sub using (term) group by 1, 2, 3),
held as (select distinct doc_id, which from piece),
every as materialized (select b.doc_id, b.which, r.k, case when s.doc_id is null then substr(sha256(case when b.which = 0 then x else z end), 1, 8) else coalesce(h, '00000000') end as h
  from (select doc_id, x, z, unnest([0, 1]) as which from e) b cross join range(33) r(k) left join held s on s.doc_id = b.doc_id and s.which = b.which left join piece p on p.doc_id = b.doc_id and p.which = b.which and p.k = r.k),
print as (select doc_id, which, string_agg(h, '' order by k) as f from every group by 1, 2),
near as (select e.doc_id, count(*) filter (a.h = b.h and a.h <> '00000000') / count(*) filter (a.h <> '00000000' or b.h <> '00000000') as near_edited,
  count(*) filter (a.h = c.h and a.h <> '00000000') / count(*) filter (a.h <> '00000000' or c.h <> '00000000') as near_next
  from e join every a on a.doc_id = e.doc_id and a.which = 0 join every b on b.doc_id = e.doc_id and b.which = 1 and b.k = a.k join every c on c.doc_id = e.next_id and c.which = 0 and c.k = a.k group by 1)
select doc_id, n as n_chars, sha256(z) as edited_sha256, p.f as fingerprint, q.f as edited_fingerprint, near_edited, near_next
from e join print p using (doc_id) join print q using (doc_id) join near using (doc_id) where p.which = 0 and q.which = 1"""
