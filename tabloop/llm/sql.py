"""SQL of the queries of this subpackage that SQL can express, for DuckDB."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"'[^\x20\x09-\x0D]+'"

SEARCH = """
with v as (
  select vec_id, row_number() over () as r,
    list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as c
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, q.r as qr, d.vec_id, d.r,
    cast(list_sum(list_transform(list_zip(q.c, d.c), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v d on q.r <> d.r and len(q.c) = len(d.c) where q.vec_id % 20 = 0)
select query_id, cast(place as integer) as rank, vec_id, score
from (select *, row_number() over (partition by qr order by score desc, vec_id, r) as place from s) where place <= 20"""

NEAR = f"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {WORD}) as w from documents),
s as (
  select distinct doc_id, unnest(case when len(w) >= 3
    then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from d),
n as (select doc_id, count(*) as n from s group by 1),
k as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (
  select a, b from k join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 90 * (x.n + y.n - k)),
e as (select a, b from l union all select b, a from l),
reach(doc_id, root) as (
  select doc_id, doc_id from d union select e.b, reach.root from reach join e on e.a = reach.doc_id)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, m.component_id
from d left join n using (doc_id) join (select doc_id, min(root) as component_id from reach group by 1) m using (doc_id)"""


def deal(name: str, source: str, parents: list[str], child: str, weight: str, budgets: str | None, budget: str = "") -> str:
    """Children of each node with their budgets, as mixing.deal gives them."""
    path = ", ".join([*parents, child])
    by = f"partition by {', '.join(parents)} " if parents else ""
    given = f"join {budgets} using ({', '.join(parents)})" if budgets else ""
    value = "budget" if budgets else budget
    return f"""{name}_a as (select {path}, sum(capacity) as capacity, cast(max({weight}) as double) as weight from {source} group by all),
{name}_b as (select {path}, capacity, weight, cast({value} as double) as budget from {name}_a {given}),
{name}_c as (
  select *, coalesce(sum(capacity) over (soon rows between unbounded preceding and 1 preceding), 0) as taken,
    sum(weight) over (soon rows between current row and unbounded following) as open
  from {name}_b window soon as ({by}order by capacity / weight, {child})),
{name}_d as (select *, taken + capacity / weight * open <= budget as is_full from {name}_c),
{name}_e as (
  select *, coalesce(sum(case when is_full then capacity end) over ({by}), 0) as filled,
    sum(case when not is_full then weight end) over ({by}) as rest_weight from {name}_d),
{name} as (
  select {path}, case when is_full then capacity else (budget - filled) / rest_weight * weight end as budget from {name}_e)"""


def mixing(share: float, epochs: int, seed: int) -> str:
    tree = ["domain", "lang", "source"]
    key = f"(('0x' || substr(md5(id || ':' || epoch || ':{seed}'), 1, 8))::bigint)"
    return f"""
with t as (
  select doc_id, cast(doc_id as varchar) as id, lang, source, md5(coalesce(text, '')) as h,
    coalesce(try_cast(regexp_extract(source, '(\\d+)$', 1) as integer), 0) as num,
    cast(len(regexp_extract_all(coalesce(text, ''), {WORD})) as bigint) as n_tokens
  from documents),
d as (
  select *, 'd' || (num % 4) as domain, 4 - num % 4 as w0, case when lang = 'en' then 5 else 2 end as w1, 1 + num % 3 as w2
  from t where n_tokens > 0),
leaf as (
  select domain, lang, source, cast(sum(n_tokens) as bigint) as supply, cast(sum(n_tokens) as double) * {epochs} as capacity,
    max(w0) as w0, max(w1) as w1, max(w2) as w2 from d group by all),
total as (select least(floor(sum(supply) * {share}::double), cast(sum(capacity) as double)) as budget from leaf),
{deal("b0", "leaf", tree[:0], tree[0], "w0", None, "(select budget from total)")},
{deal("b1", "leaf", tree[:1], tree[1], "w1", "b0")},
{deal("b2", "leaf", tree[:2], tree[2], "w2", "b1")},
q as (
  select domain, lang, source, supply, cast(least(floor(budget + 1e-6), supply * {epochs}) as bigint) as quota
  from leaf join b2 using (domain, lang, source)),
w as (select *, quota // supply as whole, quota % supply as rest from q),
x as (
  select d.*, whole, rest, cast(epoch as integer) as epoch
  from d join w using (domain, lang, source), unnest(range(1, whole + case when rest > 0 then 1 else 0 end + 1)) as u(epoch)),
o as (
  select *, coalesce(sum(n_tokens) over (partition by domain, lang, source, epoch order by {key}, id, h
    rows between unbounded preceding and 1 preceding), 0) as before from x)
select doc_id, domain, lang, source, n_tokens, epoch from o where epoch <= whole or before < rest"""


CRC32 = """
steps(n, k, c) as (
  select n, 0, cast(n as bigint) from range(256) r(n)
  union all select n, k + 1, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end from steps where k < 8),
bytes as (select list(c order by n) as t from steps where k = 8)"""


def crc32(text: str) -> str:
    """Checksum of a text's bytes; `t` is the table of `bytes`."""
    pairs = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: cast('0x' || x as bigint))"
    step = "lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), {pairs}), {step}))"


def descent(name: str, source: str, shards: int) -> str:
    """The shard that each `key` of `source` descends to, in racks of four and regions of eight shards."""
    parts, below = [], f"select id, key, 0 as node from {source}"
    for level, width in (("region", 8), ("rack", 4), ("shard", 1)):
        wide = {"region": shards, "rack": 8, "shard": 4}[level]
        number = f"cast('0x' || substr(md5(key || ':{level}:' || child || ':11'), 1, 13) as bigint)"
        parts.append(f"""{name}_{level} as (
  select id, key, child as node from (
    select id, key, child, row_number() over (
      partition by id order by -ln((cast({number} as double) + 0.5) / 4503599627370496) / weight, child) as place
    from (select p.id, p.key, w.child, w.weight from ({below}) p join (
      select s // {width} as child, s // {wide} as parent, cast(count(*) as double) as weight
      from range({shards}) r(s) group by all) w on w.parent = p.node)) where place = 1)""")
        below = f"select id, key, node from {name}_{level}"
    return ",\n".join(parts)


SHARDING = f"""
with recursive {CRC32},
d as (
  select row_number() over () as id, doc_id, coalesce(cast(doc_id as varchar), 'null') as key,
    cast(octet_length(encode(coalesce(text, ''))) + 1 as bigint) as size, {crc32("coalesce(text, '')")} as text_crc32
  from documents, bytes),
{descent("own", "d", 16)},
{descent("more", "d", 17)}
select doc_id, size, cast(text_crc32 as bigint) as text_crc32, 'key' as law, cast(o.node // 8 as integer) as region,
  cast(o.node // 4 as integer) as rack, cast(o.node as integer) as shard,
  row_number() over (partition by o.node order by
    cast('0x' || substr(md5(d.key || ':' || size || ':' || text_crc32 || ':11'), 1, 13) as bigint),
    doc_id nulls first, size, text_crc32) - 1 as slot, cast(m.node as integer) as grown_shard
from d join own_shard o using (id) join more_shard m using (id)"""


AUDIT = f"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), {WORD}) as w
  from documents),
k as (
  select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
  from labels group by 1),
f as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    len(w) < 200 as a, 100 * len(list_distinct(w)) < 50 * len(w) as b,
    100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) as c, regexp_matches(t, '[#$%&*|]') as d,
    coalesce(doc_id > min(doc_id) over (partition by t), false) as e
  from d left join k using (doc_id)),
fails as (
  select part, good, toxic, (case when a then 'A' else '' end) || (case when b then 'B' else '' end)
    || (case when c then 'C' else '' end) || (case when d then 'D' else '' end) || (case when e then 'E' else '' end) as failed
  from f),
counted as (
  select part, failed, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic
  from fails group by 1, 2),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (
  select filter_order, cast(step as integer) as step, filter_order[step] as own, filter_order[1:step - 1] as earlier
  from orders, range(1, 6) r(step)),
every as (
  select part, filter_order, step, own, n, good, toxic, contains(failed, own) as fails, failed = own as alone,
    len(list_intersect(string_split(failed, ''), string_split(earlier, ''))) > 0 and failed <> '' and earlier <> '' as gone
  from counted, steps),
summed as (
  select part, filter_order, step, own,
    coalesce(sum(n) filter (where not fails and not gone), 0) as kept,
    coalesce(sum(n) filter (where fails and not gone), 0) as removed,
    coalesce(sum(n) filter (where fails and gone), 0) as redundant,
    coalesce(sum(n) filter (where alone), 0) as unique_fails,
    coalesce(sum(good) filter (where fails and not gone), 0) as good_lost,
    coalesce(sum(toxic) filter (where fails and not gone), 0) as toxic_lost
  from every group by 1, 2, 3, 4)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, own) as bigint) as shapley
from summed"""


HARD = """
with v as (
  select vec_id, row_number() over () as r, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as c
  from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.r as ar, a.vec_id as anchor_id, b.r as br, b.vec_id as other_id, a.label = b.label as alike,
    cast(list_sum(list_transform(list_zip(a.c, b.c), lambda p: p[1] * p[2])) as bigint) as score
  from v a join v b on a.r <> b.r and len(a.c) = len(b.c) where a.vec_id % 100 = 0),
p as (
  select * from (
    select *, row_number() over (partition by ar order by score desc, other_id nulls first, br) as place from s where alike)
  where place <= 5),
n as (
  select p.anchor_id, p.other_id as positive_id, s.other_id as negative_id, p.score as positive_score,
    s.score as negative_score,
    row_number() over (partition by p.ar, p.br order by s.score desc, s.other_id nulls first, s.br) as place
  from p join s on p.ar = s.ar and not s.alike
  where 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score)
select anchor_id, positive_id, cast(place as integer) as rank, negative_id, positive_score, negative_score
from n where place <= 10"""
