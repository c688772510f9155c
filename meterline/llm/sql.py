"""SQL for the queries whose whole result SQL can express."""

WORDS = """list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"""

OP2 = f"""
with w as (select doc_id, {WORDS} as ws from documents),
p as (select doc_id, unnest(ws) as x, generate_subscripts(ws, 1) as i from w),
win as (select doc_id, i, array_to_string(list(x) over v, ' ') as s, count(*) over v as n from p
  window v as (partition by doc_id order by i rows between current row and 19 following)),
rep as (select doc_id, i from (select doc_id, i, row_number() over (partition by s order by doc_id, i) as r from win where n = 20) where r > 1),
gone as (select p.doc_id, p.i, p.x, max(rep.i) over (partition by p.doc_id order by p.i rows between 19 preceding and current row) is not null as g
  from p left join rep on p.doc_id = rep.doc_id and p.i = rep.i),
runs as (select *, g and not coalesce(lag(g) over (partition by doc_id order by i), false) as starts from gone)
select w.doc_id, count(x) as n_words, count(x) filter (g) as n_removed, count(x) filter (starts) as n_spans,
  sha256(coalesce(string_agg(x, ' ' order by i) filter (not g), '')) as kept_sha256
from w left join runs on w.doc_id = runs.doc_id group by w.doc_id"""

OP5 = f"""
with w as (select doc_id, coalesce(text, '') as t, {WORDS} as ws from documents),
p as (select doc_id, unnest(ws) as x, generate_subscripts(ws, 1) as i from w),
tri as (select doc_id, i, array_to_string(list(x) over v, ' ') as s, count(*) over v as n from p
  window v as (partition by doc_id order by i rows between current row and 2 following)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, s) as c from tri where n = 3) where c > 1),
rep as (select doc_id, count(distinct k) as n from (select doc_id, unnest([i, i + 1, i + 2]) as k from twice) group by doc_id),
m as (select w.doc_id, t, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols,
    list_filter(string_split(t, chr(10)), lambda y: regexp_matches(y, '[^\\x20\\x09-\\x0D]')) as ls, coalesce(rep.n, 0) as n_repeat_words
  from w left join rep on w.doc_id = rep.doc_id),
b as (select *, len(ls) - len(list_distinct(ls)) as n_dup_lines, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > n_words or (n_dup_lines > 3 and 2 * n_dup_lines > len(ls))
    or word_chars < 2 * n_words or word_chars > 20 * n_words
    or 2 * length(regexp_replace(t, '[^\\p{{L}}\\p{{M}}]+', '', 'g')) < word_chars) as kept
from b"""

OP6 = """
with recursive w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from documents),
p as (select doc_id, len(ws) as m, unnest(ws) as x, generate_subscripts(ws, 1) as i from w),
g as (select doc_id, m, array_to_string(list(x) over v, ' ') as s, count(*) over v as n, i from p
  window v as (partition by doc_id order by i rows between current row and 3 following)),
sh as (select distinct doc_id, s from g where n = 4 or (m < 4 and i = 1)),
c as (select doc_id, count(*) as n from sh group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as k from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (select a, b from pairs join c x on a = x.doc_id join c y on b = y.doc_id where 100 * k >= 85 * (x.n + y.n - k)),
both_ways as (select a, b from links union select b, a from links),
reach(a, b) as (select a, b from both_ways union select r.a, l.b from reach r join both_ways l on r.b = l.a)
select w.doc_id, coalesce(max(c.n), 0) as n_shingles, least(w.doc_id, coalesce(min(r.b), w.doc_id)) as component_id
from w left join c on w.doc_id = c.doc_id left join reach r on r.a = w.doc_id group by w.doc_id"""

OP7 = r"""
with recursive m as (select row_number() over () as id, * from conversations),
s as (select id, conv_id, turn, string_split(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(10)) as ls from m),
l as (select id, conv_id, turn, unnest(ls) as line, generate_subscripts(ls, 1) as i from s),
k as (select *, length(regexp_replace(regexp_extract(line, '^[> \t]*>', 0), '[^>]', '', 'g')) as lev,
  regexp_replace(lower(regexp_replace(line, '^[> \t]*>', '')), '[^\p{L}\p{N}]+', '', 'g') as bare from l),
r as (select *, sum(new) over (partition by id order by i) as run from (select *, coalesce(lev <> lag(lev) over (partition by id order by i), true)::int as new from k)),
own as (select conv_id, turn, chr(10) || string_agg(bare, chr(10) order by i) || chr(10) as body from k where lev = 0 and bare <> '' group by conv_id, turn, id),
p as (select id, conv_id, turn, run, lev, chr(10) || string_agg(bare, chr(10) order by i) || chr(10) as body from r where lev > 0 and bare <> '' group by id, conv_id, turn, run, lev),
whole as (select p.id, p.run, max(own.turn) as source from p join own on p.conv_id = own.conv_id and own.turn < p.turn and contains(own.body, p.body) group by p.id, p.run),
single as (select q.id, q.i, max(own.turn) as source from r q join own on q.conv_id = own.conv_id and own.turn < q.turn and contains(own.body, chr(10) || q.bare || chr(10)) where q.lev > 0 and q.bare <> '' group by q.id, q.i),
links as (select q.conv_id, q.turn, q.lev, coalesce(whole.source, single.source) as source, count(*) as n
  from r q left join whole on q.id = whole.id and q.run = whole.run left join single on q.id = single.id and q.i = single.i
  where q.lev > 0 and q.bare <> '' and coalesce(whole.source, single.source) is not null group by all),
tree as (select conv_id, turn, source as parent from (select *, row_number() over (partition by conv_id, turn order by lev, n desc, source desc) as o from links) where o = 1),
up(conv_id, turn, root) as (select conv_id, turn, parent from tree union all select up.conv_id, up.turn, t.parent from up join tree t on up.conv_id = t.conv_id and up.root = t.turn),
shown as (select id, count(*) filter (lev > 0) as n_quoted, max(lev) as depth, coalesce(string_agg(line, chr(10) order by i) filter (lev = 0), '') as body from k group by id)
select m.conv_id, m.turn, m.role, n_quoted, depth::int as depth, tree.parent as parent_turn, coalesce(x.root, m.turn) as root_turn,
  regexp_replace(body, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as body
from m join shown on m.id = shown.id left join tree on m.conv_id = tree.conv_id and m.turn = tree.turn
left join (select conv_id, turn, min(root) as root from up group by all) x on m.conv_id = x.conv_id and m.turn = x.turn"""

OP13 = r"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents),
k as (select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as own from l),
c as (select own, max(doc_id) as keep from k where length(own) >= 40 group by own having count(distinct doc_id) >= 5),
g as (select k.doc_id, i, line, c.own is not null and k.doc_id <> c.keep as gone from k left join c on k.own = c.own)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from g group by doc_id"""

OP12 = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as x
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_dot_product(a.x, b.x)::bigint as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.x) = len(b.x)),
p as (select anchor_id, id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (select p.*, s.id as negative_id, s.score as negative_score, row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.id) as rank
  from p join s on p.anchor_id = s.anchor_id and not s.same and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 10"""
