"""ANSI SQL for the registered queries, over the same parquet tables."""

from __future__ import annotations

_RATINGS = """
ratings as (
  select cast(o_custkey as int) as user_id,
         cast(l_partkey as int) as product_id,
         cast((cast(l_quantity as int) - 1) % 5 + 1 as double) as score,
         cast(epoch(o_orderdate) as bigint) as ts
  from lineitem join orders on l_orderkey = o_orderkey)"""

_EVENT_RATINGS = """
event_ratings as (
  select event_id,
         cast(user_id as int) as user_id,
         cast(json_extract_string(props, '$.k') as int) as product_id,
         cast(case event_type when 'purchase' then 5 when 'signup' then 4
                              when 'click' then 3 when 'view' then 2 else 1 end as double) as score,
         cast(floor(epoch(ts)) as bigint) as ts
  from events)"""

_PRODUCTS = """
products as (
  select cast(p_partkey as int) as product_id,
         p_name as name,
         p_type as categories,
         concat('img/', p_partkey) as image_url,
         replace(concat_ws('|', p_name, p_brand, p_type), ' ', '|') as tags
  from part)"""


def _co_ratings(source: str) -> str:
    return f"""
n_item as (select product_id, count(*) as n from {source} group by 1),
n_pair as (
  select a.product_id as product_id, b.product_id as rid, count(*) as n
  from {source} a join {source} b on a.user_id = b.user_id and a.product_id <> b.product_id
  group by 1, 2),
sims as (
  select p.product_id, p.rid, p.n / sqrt(cast(x.n as double) * y.n) as r
  from n_pair p join n_item x on x.product_id = p.product_id join n_item y on y.product_id = p.rid)"""


def _times(x: str, factor: int) -> str:
    return f"(({x}) * {factor} % 4294967296)"


def _rotated(x: str, bits: int) -> str:
    return f"(({x}) * {2 ** bits} % 4294967296 + ({x}) // {2 ** (32 - bits)})"


def _murmur_word(x: str) -> str:
    return _times(_rotated(_times(x, 3432918353), 15), 461845907)


def _byte(offset: int) -> str:
    """A byte of `term` (ASCII), 0 beyond its end, in its place of a word."""
    return (f"case when length(term) >= pos + {offset + 1} then "
            f"cast(ascii(substr(term, pos + {offset + 1}, 1)) as ubigint) * {256 ** offset} else 0 end")


# The bucket of each row of `terms`: MurmurHash3 (32 bits, seed 42) of the word,
# as a signed number modulo 189.
_TERM_BUCKETS = f"""
rounds(term, pos, h) as (
  select term, 0, cast(42 as ubigint) from terms
  union all
  select term, pos + 4, ({_rotated('x', 13)} * 5 + 3864292196) % 4294967296
  from (select term, pos, xor(h, {_murmur_word(' + '.join(map(_byte, range(4))))}) as x
        from rounds where pos + 4 <= length(term))),
ends as (
  select term, xor(xor(h, {_murmur_word(' + '.join(map(_byte, range(3))))}), cast(length(term) as ubigint)) as h
  from rounds where pos + 4 > length(term)),
stirred as (select term, {_times('xor(h, h // 65536)', 2246822507)} as h from ends),
stirred_again as (select term, {_times('xor(h, h // 8192)', 3266489909)} as h from stirred),
hashed as (select term, cast(xor(h, h // 65536) as bigint) as h from stirred_again),
buckets as (
  select term, ((case when h >= 2147483648 then h - 4294967296 else h end) % 189 + 189) % 189 as bucket
  from hashed)"""

_LIVE = f"""{_EVENT_RATINGS},
history as (select * from event_ratings where event_id <= 0.8 * (select max(event_id) from events)),
live as (select * from event_ratings where event_id > 0.8 * (select max(event_id) from events)),
{_co_ratings('history')},
recent as (
  select * from (
    select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rank from live)
  where rank <= 20)"""


def _candidates(requests: str, rated: str = "history") -> str:
    return f"""
requests as ({requests}),
candidates as (
  select * from (
    select q.user_id, q.product_id, s.rid, s.r,
           row_number() over (partition by q.user_id, q.product_id order by s.r desc, s.rid) as rank
    from requests q join sims s on s.product_id = q.product_id
    where not exists (select 1 from {rated} h where h.user_id = q.user_id and h.product_id = s.rid))
  where rank <= 20)"""


def _scores(rated: str) -> str:
    return f"""{_LIVE},
rated as (select user_id, product_id from history union select user_id, product_id from live),
{_candidates('select user_id, product_id from recent where rank = 1', rated)},
scores as (
  select c.user_id, c.rid as product_id,
         round(avg(s.r * t.score)
               + log2(greatest(count(*) filter (where t.score > 3), 1))
               - log2(greatest(count(*) filter (where t.score <= 3), 1)), 6) as score
  from candidates c
  join recent t on t.user_id = c.user_id
  join sims s on s.product_id = c.rid and s.rid = t.product_id
  group by 1, 2)"""

_ITEM_CF = f"""
with {_RATINGS}, {_co_ratings('ratings')},
ranked as (select *, row_number() over (partition by product_id order by r desc, rid) as rank from sims)
select product_id, rid, round(r, 6) as r, cast(rank as int) as rank from ranked where rank <= 5"""

_RANKED_SCORES = """
select user_id, product_id, score,
       cast(row_number() over (partition by user_id order by score desc, product_id) as int) as rank
from scores"""

ORACLES: dict[str, str] = {
    "load_products": f"with {_PRODUCTS} select product_id, name, categories, image_url, tags from products",
    "load_ratings": f"with {_RATINGS} select * from ratings",
    "rate_more_products": f'with {_RATINGS} select product_id, count(*) as "count" from ratings group by 1',
    "rate_more_recently_products": f"""
with {_RATINGS}
select product_id, count(*) as "count",
       cast(strftime(make_timestamp(ts * 1000000), '%Y%m') as int) as yearmonth
from ratings group by 1, 3""",
    "average_products": f'with {_RATINGS} select product_id, avg(score) as "avg" from ratings group by 1',
    "dense_cosine_topk": """
with vectors as (select vec_id, cast(embedding as double[]) as v from embeddings),
pairs as (
  select a.vec_id, b.vec_id as rid, floor(list_cosine_similarity(a.v, b.v) * 1e6 + 0.5) / 1e6 as r
  from vectors a join vectors b on a.vec_id <> b.vec_id
  where list_dot_product(a.v, b.v) > 0),
ranked as (select *, row_number() over (partition by vec_id order by r desc, rid) as rank from pairs)
select vec_id, rid, r, cast(rank as int) as rank from ranked where rank <= 5""",
    "dense_dot_topk": """
with vectors as (select vec_id, cast(embedding as double[]) as v from embeddings),
catalogue as (select * from vectors where vec_id in (select doc_id from labels)),
pairs as (
  select a.vec_id, b.vec_id as rid, floor(list_dot_product(a.v, b.v) * 1e6 + 0.5) / 1e6 as r
  from vectors a cross join catalogue b where list_dot_product(a.v, b.v) > 0),
ranked as (select *, row_number() over (partition by vec_id order by r desc, rid) as rank from pairs)
select vec_id, rid, r, cast(rank as int) as rank from ranked where rank <= 20""",
    "part_score_topk": """
with c as (select c_custkey, sqrt(c_acctbal::double + 1000) / 10 as c1, c_nationkey::double / 10 as c2 from customer),
p as (
  select p_partkey, p_size * sqrt(p_size::double) / 100 as p1, sqrt(p_retailprice::double) / 100 as p2,
    (p_size % 3)::double as p3
  from part),
pairs as (
  select c_custkey, p_partkey, c1 * p1 + c2 * p2 + p3 as dot from c cross join p where c1 * p1 + c2 * p2 + p3 > 0),
scored as (select c_custkey, p_partkey, floor(dot * 1e6 + 0.5) / 1e6 as r from pairs),
ranked as (select *, row_number() over (partition by c_custkey order by r desc, p_partkey) as rank from scored)
select c_custkey, p_partkey, r, cast(rank as int) as rank from ranked where rank <= 20""",
    "season_sims": f"""
with {_RATINGS},
months as (
  select product_id, [{', '.join(f'count(*) filter (m = {m})::double' for m in range(1, 13))}] as v
  from (select product_id, month(make_timestamp(ts * 1000000)) as m from ratings) group by 1),
vectors as (select min(product_id) as product_id, v, count(*) as copies from months group by v)
select a.product_id, b.product_id as rid, floor(list_cosine_similarity(a.v, b.v) * 1e6 + 0.5) / 1e6 as r,
  a.copies, b.copies as r_copies
from vectors a join vectors b on a.product_id < b.product_id
where floor(list_cosine_similarity(a.v, b.v) * 1e6 + 0.5) / 1e6 >= 0.95""",
    "item_cf_sims": _ITEM_CF,
    "item_cf_sims_increments": _ITEM_CF,
    "content_sims": f"""
with {_PRODUCTS},
words as (
  select product_id, unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) as term from products),
tf as (select product_id, term, count(*) as tf from words where term <> '' group by 1, 2),
df as (select term, count(*) as df from tf group by 1),
weighted as (
  select product_id, term, tf * ln(((select count(*) from products) + 1.0) / (df + 1)) as w
  from tf join df using (term)),
lengths as (select product_id, sqrt(sum(w * w)) as len from weighted group by 1),
dots as (
  select a.product_id, b.product_id as rid, sum(a.w * b.w) as dot
  from weighted a join weighted b on a.term = b.term and a.product_id <> b.product_id
  group by 1, 2),
ranked as (
  select product_id, rid, r, row_number() over (partition by product_id order by r desc, rid) as rank
  from (select d.product_id, d.rid, floor(d.dot / (x.len * y.len) * 1e6 + 0.5) / 1e6 as r
        from dots d join lengths x on x.product_id = d.product_id join lengths y on y.product_id = d.rid
        where d.dot > 0))
select product_id, rid, r, cast(rank as int) as rank from ranked where rank <= 5""",
    "content_sims_hashed": f"""
with recursive {_PRODUCTS},
words as (
  select product_id, unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) as term from products),
terms as (select distinct term from words),
{_TERM_BUCKETS},
tf as (select product_id, bucket, count(*) as tf from words join buckets using (term) group by 1, 2),
df as (select bucket, count(*) as df from tf group by 1),
weighted as (
  select product_id, bucket, tf * ln(((select count(*) from products) + 1.0) / (df + 1)) as w
  from tf join df using (bucket)),
lengths as (select product_id, sqrt(sum(w * w)) as len from weighted group by 1 having sum(w * w) > 0),
dots as (
  select a.product_id, b.product_id as rid, sum(a.w * b.w) as dot
  from weighted a join weighted b on a.bucket = b.bucket and a.product_id <> b.product_id
  group by 1, 2),
pairs as (
  select x.product_id, y.product_id as rid, floor(coalesce(d.dot, 0.0) / (x.len * y.len) * 1e6 + 0.5) / 1e6 as r
  from lengths x join lengths y on x.product_id <> y.product_id
  left join dots d on d.product_id = x.product_id and d.rid = y.product_id),
ranked as (select *, row_number() over (partition by product_id order by r desc, rid) as rank from pairs)
select product_id, rid, r, cast(rank as int) as rank from ranked where rank <= 5""",
    "rating_rmse": f"""
with {_RATINGS},
means as (select product_id, avg(score) as prediction from ratings group by 1)
select round(sqrt(avg(power(score - prediction, 2))), 6) as rmse, count(*) as n
from ratings join means using (product_id)""",
    "parse_rating_messages": f"""
with {_EVENT_RATINGS} select event_id as seq, user_id, product_id, score, ts from event_ratings""",
    "user_recent_ratings": f"""
with {_EVENT_RATINGS},
ranked as (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rank from event_ratings)
select event_id, user_id, product_id, score, ts, cast(rank as int) as rank from ranked where rank <= 20""",
    "top_similar_unrated": f"""
with {_LIVE}, {_candidates('select distinct user_id, product_id from live')}
select user_id, product_id, rid, round(r, 6) as r, cast(rank as int) as rank from candidates""",
    "stream_priority_score": f"with {_scores('history')} select user_id, product_id, score from scores",
    "stream_recs": f"with {_scores('history')} {_RANKED_SCORES}",
    "stream_recs_unrated": f"with {_scores('rated')} {_RANKED_SCORES}",
}
