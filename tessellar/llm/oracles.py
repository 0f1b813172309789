"""SQL of the operators that SQL can express, for DuckDB."""

from __future__ import annotations

from tessellar.llm import chat, quality

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
NUMBER = "(('0x' || substr({}, 1, 12))::bigint)"


def apportion(name: str, table: str, by: str, key: str, weight: str) -> str:
    """CTEs that end in ``name``: ``table`` (by, key, weight, seats, most) with its quota by highest quotients."""
    share = f"floor(case when all_ > 0 then {weight} * (seats {{}} n_ / 2.0::double) / all_ else 0.0::double end + 0.5::double - 1e-9::double)::bigint"
    return f"""{name}_1 as (select *, sum({weight}) over (partition by {by}) as all_, count(*) over (partition by {by}) as n_ from {table}),
    {name}_2 as (select *, greatest(0, least(most, {share.format('-')})) as lo_, least(most, {share.format('+')} + 2) as hi_ from {name}_1),
    {name}_3 as (select *, seats - sum(lo_) over (partition by {by}) as left_ from {name}_2),
    {name}_4 as (select {by}, {key}, left_, {weight} as w_, unnest(range(lo_, hi_)) as s_ from {name}_3 where hi_ > lo_ and left_ > 0),
    {name}_5 as (select {by}, {key}, count(*) as won_ from (select *, row_number() over (partition by {by} order by w_ / (2 * s_ + 1) desc, {key}) as r_ from {name}_4) where r_ <= left_ group by 1, 2),
    {name} as (select t.*, lo_ + coalesce(won_, 0) as quota from {name}_3 t left join {name}_5 using ({by}, {key}))"""


MIXING = f"""
with d as (select doc_id, coalesce('=' || source, chr(1114111)) as sk, coalesce(len({WORDS}), 0)::bigint as size, md5('mix:' || coalesce(doc_id::varchar, '')) as h from documents),
src as (select sk, sum(size)::bigint as source_size from d group by 1),
w as (select *, [5.0::double, 2.0::double, 1.0::double][((row_number() over (order by sk) - 1) % 3 + 1)::int] as weight, source_size * 2.0::double as cap, (sum(source_size) over ())::double * 1.5::double as want from src),
f as (select *, (want - coalesce(sum(cap) over (order by cap / weight, sk rows between unbounded preceding and 1 preceding), 0.0::double)) / sum(weight) over (order by cap / weight, sk rows between current row and unbounded following) as level from w),
g as (select *, cap <= level * weight as whole from f),
t as (select sk, source_size, case when whole then cap else (select arg_min(level, (cap / weight, sk)) from g where not whole) * weight end as target from g),
t1 as (select *, 0 as one, floor(sum(target) over () / 16)::bigint as seats, source_size * 2 // 16 as most from t),
{apportion('b', 't1', 'one', 'sk', 'target')},
b1 as (select sk, source_size, target, quota as seats, least(4096, greatest(1, ceil(source_size / 65536.0::double)))::bigint as shards from b),
x as (select d.*, {NUMBER.format('h')} % shards as shard from d join b1 using (sk)),
s as (select sk, shard, sum(size)::bigint as shard_size from x group by 1, 2),
s1 as (select s.*, source_size, target, seats, shard_size::double as weight, shard_size * 2 // 16 as most from s join b1 using (sk)),
{apportion('q', 's1', 'sk', 'shard', 'weight')},
q1 as (select sk, shard, shard_size, quota, source_size, target, {NUMBER.format("md5('mix:' || sk || ':' || shard)")} % greatest(1, shard_size) as place from q),
y as (select x.*, (sum(size) over (partition by sk, shard order by h, size, doc_id rows unbounded preceding) - size)::bigint as a from x),
z as (select y.*, shard_size, source_size, target, quota, place, quota * 16 // greatest(1, shard_size) as whole, quota * 16 % greatest(1, shard_size) as rest from y join q1 using (sk, shard))
select doc_id, size, source_size, target, (whole * size + greatest(0, least(a + size, place + rest) - greatest(a, place)) + greatest(0, least(a + size, place + rest - shard_size) - a))::bigint as taken, shard, quota::bigint as quota_blocks from z
"""

_esc = r"replace(replace({}, '\', '\\'), '<|', '<\|')"
CHAT = f"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from (select conv_id, turn, role, text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
f as (select *, length('{chat.START}' || {_esc.format('role')} || chr(10) || {_esc.format('text')} || '{chat.END}' || chr(10)) as n, row_number() over w as i, row_number() over (partition by conv_id order by turn desc, role desc, text desc) as j from c window w as (partition by conv_id order by turn, role, text)),
g as (select *, sum(n) over (partition by conv_id order by i) as done from f)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars, sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
  sum(case when role = 'assistant' or j = 1 then done else 0 end)::bigint as formatted_chars
from g group by conv_id
"""

WARC = """
with p as (select page_id, coalesce(html, '') as html from pages), q as (select page_id, strlen(html) as payload_bytes, sha1(html) as payload_digest from p),
r as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest, payload_bytes) else page_id end as owner from q)
select page_id, payload_bytes, payload_digest, case when owner is distinct from page_id then 'revisit' else 'response' end as record_type, case when owner is distinct from page_id then owner end as refers_to from r
"""

_rules = {k: v.replace(" / greatest", "::double / greatest") for k, v in quality.RULES.items()}


def quality_ctes(risk: float, delta: float) -> str:
    """CTEs up to ``s2`` (statistics), ``tested`` and ``cuts``."""
    alpha = f"({risk!r}::double / {len(_rules)})"
    return f"""
with t as (select doc_id, lang, coalesce(text, '') as text from documents),
t2 as (select row_number() over () as rid, doc_id, lang, text, {WORDS} as w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from t),
g as (select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as k from (select rid, w, unnest(range(1, len(w) - 1)) as i from t2)),
r as (select rid, i from (select rid, i, count(*) over (partition by rid, k) as n from g) where n > 1),
c as (select rid, count(distinct i + j) as n_repeat_words from r, range(3) x(j) group by 1),
s as (select doc_id, lang, len(w)::bigint as n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::bigint as word_chars, (length(text) - length(translate(text, '{quality.SYMBOLS}', '')))::bigint as n_symbols,
  len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, length(regexp_replace(text, '[^\\p{{Lu}}]+', '', 'g'))::bigint as n_capitals,
  (length(text) - length(translate(text, '!?', '')))::bigint as n_exclaims, coalesce(n_repeat_words, 0)::bigint as n_repeat_words from t2 left join c using (rid)),
s2 as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from s),
y as (select doc_id, min(quality) as quality from labels where quality is not null and doc_id is not null group by 1),
good as (select s2.* from s2 join y using (doc_id) where quality = 1 and not base_failed),
v as ({' union all '.join(f"select lang, '{k}' as rule, {x} as v from good" for k, x in _rules.items())}),
grid as (select unnest({[g for g in quality.GRID]}::double[]) as cutoff, unnest(range({len(quality.GRID)})) as step),
k as (select lang, rule, step, cutoff, count(*) as n, count(*) filter (v > cutoff) as k from v, grid group by 1, 2, 3, 4),
terms as (select lang, rule, step, cutoff, n, k, unnest(case when k > n * {alpha} then range(0) else range(k + 1) end) as i from k),
cdf as (select lang, rule, step, cutoff, sum(exp((case when n > 0 then lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) end) + i * ln({alpha}) + (n - i) * ln(1 - {alpha}))) as p from terms group by 1, 2, 3, 4),
tested as (select k.lang, k.rule, k.step, k.cutoff, k.n, k.k, coalesce(p, 1.0) as p, {delta}::double / {len(_rules)} / (select count(*) from (select distinct lang from good)) as level from k left join cdf on k.lang is not distinct from cdf.lang and k.rule = cdf.rule and k.step = cdf.step),
stops as (select lang, rule, coalesce(min(step) filter (p > level), 1000) as stop from tested group by 1, 2),
cuts as (select t.lang, t.rule, arg_max(cutoff, step) as cutoff from tested t join stops s on t.lang is not distinct from s.lang and t.rule = s.rule where step < stop group by 1, 2)"""


QUALITY = f"""{quality_ctes(0.01, 0.05)},
u as (select s2.*, {', '.join(f"(select cutoff from cuts where cuts.lang is not distinct from s2.lang and rule = '{k}') as c_{k}" for k in _rules)} from s2)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not ({' or '.join(f'coalesce({x} > c_{k}, false)' for k, x in _rules.items())}) as kept from u
"""
CUTOFFS = f"""{quality_ctes(0.3, 0.2)}
select lang, rule, max(cutoff) filter (step = last)::double as cutoff, max(n)::bigint as n_good, max(k) filter (step = last)::bigint as n_rejected
from (select t.*, max(t.step) over (partition by t.lang, t.rule) as last from tested t join stops s on t.lang is not distinct from s.lang and t.rule = s.rule where t.step < stop) group by 1, 2
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: all pairs of lines that share a word of their prefixes, by exact Jaccard
LINES = rf"""
with l as (select doc_id, i, line, list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as s from (select doc_id, unnest(t) as line, unnest(range(len(t))) as i from (select doc_id, string_split({LOWER}, chr(10)) as t from documents))),
o as (select doc_id, i, list_sort(s) as s, doc_id * 1000000000 + i as place from l where len(s) > 0),
u as (select row_number() over () as sid, s, len(s) as n, min(place) as first from o group by s),
w as (select sid, n, unnest(s) as word from u),
r as (select *, row_number() over (partition by sid order by df, word) as r from (select *, count(*) over (partition by word) as df from w)),
p as (select sid, n, word from r where r <= n - (80 * n + 99) // 100 + 1),
c as (select distinct a.sid as a, b.sid as b from p a join p b on a.word = b.word and a.sid <> b.sid and 100 * a.n >= 80 * b.n and 100 * b.n >= 80 * a.n),
near as (select c.a, min(y.first) as first from (select c.*, x.s as sa, y.s as sb from c join u x on x.sid = a join u y on y.sid = b) c join u y on y.sid = c.b where 100 * len(list_intersect(sa, sb)) >= 80 * (len(sa) + len(sb) - len(list_intersect(sa, sb))) group by 1),
best as (select s, least(u.first, coalesce(near.first, u.first)) as first from u left join near on a = sid),
gone as (select doc_id, i from o join best using (s) where place > first),
t as (select doc_id, text, string_split(text, chr(10)) as t from documents),
k as (select t.doc_id, count(gone.i) as n_removed, coalesce(string_agg(gone.i::varchar, ',' order by gone.i), '') as line_removed, coalesce(string_agg(line, chr(10) order by x.i) filter (gone.i is null), '') as kept
  from (select doc_id, unnest(t) as line, unnest(range(len(t))) as i from t) x join t on t.doc_id = x.doc_id left join gone on gone.doc_id = x.doc_id and gone.i = x.i group by 1)
select t.doc_id, coalesce(n_removed, 0)::bigint as n_removed, coalesce(line_removed, '') as line_removed, case when text is not null then sha256(kept) end as kept_sha256 from t left join k using (doc_id)
"""

#: bytes as hexadecimal digits, cut into pieces first, since a substring is looked up from the start of its text
REPEATS = """
with h as (select doc_id, hex(coalesce(text, '')) as x from documents),
b as (select doc_id, o, substr(x, 2 * o + 1, 1398) as x from (select doc_id, x, unnest(range(0, len(x) // 2 - 199, 500)) as o from h)),
w as (select doc_id, o + p as p, hash(substr(x, 2 * p + 1, 400)) as k from (select doc_id, o, x, unnest(range(least(500, len(x) // 2 - 199))) as p from b)),
hit as (select doc_id, p from w where k in (select k from w group by k having count(*) > 1)),
isle as (select doc_id, min(p) as s, max(p) + 200 as e from (select *, sum(new) over (partition by doc_id order by p) as g from (select doc_id, p, case when p <= lag(p) over (partition by doc_id order by p) + 200 then 0 else 1 end as new from hit)) group by doc_id, g),
cut as (select doc_id, coalesce(lag(e) over (partition by doc_id order by s), 0) as a, s as b, e from isle),
part as (select doc_id, a, b from cut union all select doc_id, max(e), null from cut group by 1),
kept as (select doc_id, string_agg(case when b is null then substr(x, 2 * a + 1) else substr(x, 2 * a + 1, 2 * (b - a)) end, '' order by a) as x from part join h using (doc_id) group by 1),
n as (select doc_id, count(*) as n_spans, sum(e - s) as n_removed from isle group by 1)
select h.doc_id, (len(h.x) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(kept.x, h.x))) as kept_sha256 from h left join kept using (doc_id) left join n using (doc_id)
"""

#: exact Jaccard of all documents that share a shingle, and their components
NEAR = rf"""
with recursive w as (select doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, g from (select doc_id, unnest(case when len(w) < 4 then case when len(w) = 0 then [] else [array_to_string(w, ' ')] end else list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) end) as g from w)),
n as (select doc_id, count(*) as n from s group by 1),
c as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
link as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
edge as (select a, b from link union all select b, a from link),
reach as (select a as x, b as y from edge union select r.x, e.b from reach r join edge e on e.a = r.y),
m as (select x as doc_id, min(y) as low from reach group by 1)
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id, least(doc_id, coalesce(low, doc_id)) = doc_id as kept from documents left join n using (doc_id) left join m using (doc_id)
"""

#: every window that holds a shingle of an item, by exact similarity of multisets
LEAKS = rf"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
i as (select row_number() over () as iid, item_id, w, least(5, len(w)) as k from (select item_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') as w from benchmark) where len(w) > 0),
ig as (select iid, item_id, k, list_transform(range(1, len(w) - k + 2), lambda j: hash(array_to_string(w[j : j + k - 1], ' '))) as a from i),
dg as (select rid, doc_id, k, list_transform(range(1, len(w) - k + 2), lambda j: hash(array_to_string(w[j : j + k - 1], ' '))) as b from d, (select distinct k from i) where len(w) >= k),
hit as (select rid, iid, p from (select rid, k, unnest(b) as s, unnest(range(len(b))) as p from dg) join (select distinct iid, k, unnest(a) as s from ig) using (k, s)),
x as (select rid, iid, doc_id, item_id, ig.k, a, b, least(len(a), len(b)) as width from (select distinct rid, iid from hit) join ig using (iid) join dg using (rid, k)),
start as (select distinct rid, iid, unnest(range(greatest(0, p - width + 1), least(p, len(b) - width) + 1)) as p from hit join x using (rid, iid) where width * 100 >= len(a) * 80),
v as (select rid, iid, doc_id, item_id, k, width, p, a, b[p + 1 : p + width] as w from start join x using (rid, iid)),
n as (select rid, iid, doc_id, item_id, k, width, p, len(a) as size, list_sum(list_transform(list_distinct(a), lambda y: least(len(list_filter(a, lambda z: z = y)), len(list_filter(w, lambda z: z = y))))) as both_ from v),
r as (select *, both_::double / (size + width - both_) as similarity from n)
select doc_id, item_id, max(similarity) as similarity, arg_min(p, (-similarity, p))::bigint as first_word, any_value(width + k - 1)::bigint as n_words from r where similarity * 100 >= 80 group by rid, iid, doc_id, item_id
"""

ORACLES = {"op1_mixing": MIXING, "op2_line_dedup": LINES, "op4_quality_rules": QUALITY, "quality_cutoffs": CUTOFFS, "op5_suffix_dedup": REPEATS, "op6_chat_formatting": CHAT, "op7_decontamination": LEAKS, "op9_minhash": NEAR, "op10_warc": WARC}
