"""DuckDB's SQL for the queries whose results a statement can state.

The others mix by hashes, learn, or follow a tokenizer file; tests compare them with brute force.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP3 = f"""with recursive
w as (select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as ws from documents),
s as (select distinct doc_id, array_to_string(ws[i : i + 2], ' ') as shingle
      from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 2, least(len(ws), 1)) + 1)) as i from w)),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
c as (select a, min(b) as b from r group by 1)
select w.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, least(w.doc_id, coalesce(c.b, w.doc_id)) as component_id
from w left join n on w.doc_id = n.doc_id left join c on w.doc_id = c.a"""

OP4 = """with
t as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
c as (select doc_id, len(h) // 2 as n_bytes, j, substr(h, 512 * j + 1, 912) as part
      from (select doc_id, h, unnest(range(0, len(h) // 512 + 1)) as j from t)),
p as (select *, unnest(range(1, least(256, n_bytes - 256 * j) + 1)) as x from c),
k as (select doc_id, 256 * j + x as i, substr(part, 2 * x - 1, 2) as byte,
        case when 256 * j + x + 199 <= n_bytes then md5(substr(part, 2 * x - 1, 400)) end as string from p),
f as (select string from k where string is not null group by 1 having count(*) > 1),
d as (select k.*, case when f.string is not null then 1 else 0 end as dup from k left join f on k.string = f.string),
g as (select doc_id, i, byte, max(dup) over (partition by doc_id order by i rows between 199 preceding and current row) as gone from d),
b as (select *, coalesce(lag(gone) over (partition by doc_id order by i), 0) as before from g),
r as (select doc_id, sum(gone) as n_removed, sum(case when gone = 1 and before = 0 then 1 else 0 end) as n_spans,
        string_agg(byte, '' order by i) filter (where gone = 0) as kept from b group by 1)
select t.doc_id, cast(len(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  cast(coalesce(n_spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(kept, ''))) as kept_sha256
from t left join r on t.doc_id = r.doc_id"""

OP5 = f"""with
w as (select doc_id, {_WORDS.format("coalesce(text, '')")} as ws from documents),
k as (select doc_id, s, array_to_string(ws[s : s + 19], ' ') as win
      from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 19, 0) + 1)) as s from w)),
d as (select doc_id, s from k qualify row_number() over (partition by win order by doc_id, s) > 1),
g as (select distinct doc_id, unnest(range(s, s + 20)) as p from d),
o as (select doc_id, unnest(range(1, len(ws) + 1)) as p, unnest(ws) as word from w),
r as (select o.doc_id, count(g.p) as n_removed, string_agg(word, ' ' order by o.p) filter (where g.p is null) as kept
      from o left join g on o.doc_id = g.doc_id and o.p = g.p group by 1)
select w.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from w left join r on w.doc_id = r.doc_id"""

OP11 = f"""with recursive
t as (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, role, text) as i from conversations where conv_id is not null),
n as (select c, max(i) as n from t group by 1),
x as (select c, cast(c as varchar) as s, 0 as k, 4294967295::bigint as r from n
      union all
      select c, s, k + 1, xor(r0 >> 1, 3988292384 * (r0 & 1))
      from (select c, s, k, case when k % 8 = 0 then xor(r, ascii(substr(s, k // 8 + 1, 1))::bigint) else r end as r0 from x where k < 8 * len(s))),
h as (select c, xor(r, 4294967295) % 4 as h, c - c % 20 as base from x where k = 8 * len(s)),
g as (select h.*, least(h, coalesce(n.n, 0)) as given from h left join n on n.c = h.base),
r as (select g.c, t.i, role, text from g join t on t.c = g.base and t.i <= g.h
      union all select g.c, t.i - g.h + g.given, role, text from g join t on t.c = g.c and t.i > g.h),
q as (select c, i as depth, text, list(md5(len(role) || ':' || role || text)) over (partition by c order by i rows unbounded preceding) as p from r
      union all select c, 0, '', [] from n),
m as (select c, depth, list_slice(p, 1, depth) as p, text from q),
v as (select depth, p, min(c) as conv_id, count(*) as n_convs, len({_WORDS.format("any_value(text)")}) as words from m group by 1, 2),
e as (select c, max(depth) as last from m group by 1),
z as (select depth, p, string_agg(cast(m.c as varchar), ',' order by m.c) as ends from m join e on e.c = m.c and e.last = m.depth group by 1, 2),
k as (select depth - 1 as depth, p[:depth - 1] as p, count(*) as n_children from v where depth > 0 group by 1, 2),
a as (select v.*, coalesce(n_children, 0) as n_children, coalesce(ends, '') as ends
      from v left join k on k.depth = v.depth and k.p = v.p left join z on z.depth = v.depth and z.p = v.p),
b as (select m.depth, m.p, count(*) filter (where d.n_children = 0) as n_leaves, sum((d.n_convs - 1) * d.words) as saved_tokens
      from m join a d on d.conv_id = m.c and d.depth >= m.depth group by 1, 2)
select a.conv_id, cast(a.depth as bigint) as depth, up.conv_id as parent_conv_id, a.n_convs, a.n_children, b.n_leaves,
  cast(b.saved_tokens as bigint) as saved_tokens, sha256(a.ends) as ends_sha256
from a join b on b.depth = a.depth and b.p = a.p left join v up on up.depth = a.depth - 1 and up.p = a.p[:a.depth - 1]"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13 = f"""with
d as (select row_number() over (order by doc_id) as row, doc_id, {_TERMS} as ts from documents),
n as (select row, doc_id, len(ts) as n from d),
f as (select count(*) filter (where n > 0) as docs, sum(n)::bigint as length from n),
q as (select distinct item, item_id, unnest(ts) as term from (select row_number() over (order by item_id) as item, item_id, {_TERMS} as ts from benchmark)),
p as (select row, term, count(*) as tf from (select row, unnest(ts) as term from d) where term in (select term from q) group by 1, 2),
w as (select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1))) as bigint) as w from p, f group by term, docs),
s as (select item, item_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // length))))::bigint as score
      from q join p using (term) join w using (term) join n using (row), f group by 1, 2, 3)
select item_id, cast(row_number() over (partition by item order by score desc, doc_id) as integer) as rank, doc_id, score
from s join n using (row) where score > 0 qualify rank <= 10"""

ORACLES = {"op3_jaccard_join": OP3, "op4_repeated_bytes": OP4, "op5_repeated_words": OP5, "op11_prefix_trie": OP11, "op13_search": OP13}
