"""DuckDB oracle SQL for every registered query.

Each statement is self-contained: the FIXTURES.md views are inlined as CTEs
over the raw tables (which the checker registers as views).  Doubles are
rounded to 6 decimals on both sides; counts are BIGINT.
"""

from __future__ import annotations

# ---- fixture views ----------------------------------------------------------------------------

RATINGS = """ratings AS (
  select user_id, item_id, rating, ts, bucket from (
    select o_custkey as user_id, l_partkey as item_id,
           cast(ceil(l_quantity / 10) as double) as rating,
           o_orderdate as ts,
           cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) % 10 as bigint) as bucket,
           row_number() over (partition by o_custkey, l_partkey
                              order by o_orderdate desc, l_orderkey desc, l_linenumber desc,
                                       l_quantity desc, l_extendedprice desc) as rn
    from lineitem join orders on l_orderkey = o_orderkey)
  where rn = 1)"""

CATALOG = """ps AS (select distinct l_partkey pk, l_suppkey sk from lineitem),
rk AS (select pk, sk, row_number() over (partition by pk order by (sk * 7919 + pk * 31) % 101, sk) rn from ps),
act AS (select pk, string_agg('S' || sk, ' / ' order by rn) actor,
               min(case when rn = 1 then sk end) lead from rk where rn <= 6 group by pk),
catalog AS (
  select p_partkey id, p_name as name,
         case when p_partkey % 17 = 0 then '-1' else p_brand end director,
         case when p_partkey % 13 = 0 then '-1'
              else 'W' || (p_partkey % 40) || ' / W' || (p_partkey % 7) end writer,
         coalesce(actor, '-1') actor,
         p_type || '/' || split_part(p_name, ' ', 2) as filmtype,
         cast(case when p_size = 50 then -1 else 1970 + p_size end as integer) releasedate,
         coalesce(n_name, '-1') area, coalesce(r_name, '-1') as language,
         round((p_retailprice - 900) / 10, 2) score
  from part left join act on pk = p_partkey
  left join supplier on s_suppkey = lead
  left join nation on n_nationkey = s_nationkey
  left join region on r_regionkey = n_regionkey)"""

USERS = """users AS (
  select c_custkey as id,
         cast(case c_nationkey % 7 when 0 then 1 when 1 then 18 when 2 then 25 when 3 then 35
                              when 4 then 45 when 5 then 50 else 56 end as integer) as age,
         cast(c_custkey % 5 as integer) as occupation
  from customer)"""

MY_RATINGS = """my_ratings AS (
  select cast(1000000 as bigint) as user_id, p_partkey as item_id,
         cast(p_partkey % 6 as double) as rating
  from part where p_partkey % 37 = 0)"""

RATING_EVENTS = """rating_events AS (
  select event_id, user_id + case when event_id % 10 = 0 then 1000000 else 0 end as user_id,
         event_id % (select count(*) from part) as item_id,
         cast(1 + cast(floor(value) as bigint) % 5 as double) as rate, ts
  from events)"""

LAST_RECS = """last_recs AS (
  select c_custkey as user_id, (c_custkey * 13 + k * 17) % (select count(*) from part) as item_id,
         1 + cast((c_custkey * 7 + k * 3) % 80 as double) / 10 as priority
  from customer, (select unnest(range(10)) as k))"""

ORDER_EVENTS = """order_events AS (
  select l_partkey as id, cast(floor(l_extendedprice) as bigint) as price, l_shipdate as ts from lineitem)"""


EVENT_ORDERS = """event_orders AS (
  select event_id % (select count(*) from part) as id, cast(floor(value) as bigint) as price, ts from events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---- content similarity -----------------------------------------------------------------------

def _tokset(c: str, cap: int) -> str:
    return (f"list_distinct(list_transform(string_split(regexp_replace({c}, '/+$', ''), '/')[1:{cap}], "
            f"lambda x: replace(x, ' ', '')))")


def _miss(c: str) -> str:
    return f"coalesce(replace(string_split({c}, '/')[1], ' ', '') = '-1', true)"


def _chars(s: str) -> str:
    return f"(case when length({s}) = 0 then []::VARCHAR[] else list_distinct(string_split({s}, '')) end)"


FEATURES = f"""feat AS (
  select id,
         coalesce(name = '-1', true) as name_missing,
         {_chars("regexp_extract(name, '^[^:： ]*')")} as title_first,
         {_chars("regexp_extract(name, '^[^:：]*')")} as title_second,
         {_tokset('director', 3)} as director, {_miss('director')} as director_missing,
         {_tokset('writer', 3)} as writer, {_miss('writer')} as writer_missing,
         {_tokset('actor', 5)} as actor, {_miss('actor')} as actor_missing,
         {_tokset('filmtype', 10)} as ftype, {_miss('filmtype')} as ftype_missing,
         {_tokset('area', 1)} as country, {_miss('area')} as country_missing,
         {_tokset('language', 1)} as lang, {_miss('language')} as lang_missing,
         case when releasedate = -1 then null else releasedate end as year,
         case when score = -1 then null else score end as score
  from catalog)"""


def _jac(a: str, b: str) -> str:
    inter = f"len(list_intersect({a}, {b}))"
    return (f"coalesce(cast({inter} as double) / nullif(cast(len({a}) + len({b}) - {inter} as double), 0), 0.0)")


def _ovl(a: str, b: str) -> str:
    return f"(case when len(list_intersect({a}, {b})) > 0 then 1.0 else 0.0 end)"


def _guard(sim: str, m: str) -> str:
    return f"(case when a.{m} or b.{m} then 0.0 else {sim} end)"


PAIR_SIM = " + ".join([
    "3 * " + _guard(_jac("a.title_first", "b.title_second"), "name_missing"),
    "3 * " + _guard(_ovl("a.director", "b.director"), "director_missing"),
    "3 * " + _guard(_ovl("a.writer", "b.writer"), "writer_missing"),
    "2 * " + _guard(_jac("a.actor", "b.actor"), "actor_missing"),
    "5 * " + _guard(_jac("a.ftype", "b.ftype"), "ftype_missing"),
    "1 * coalesce(case when abs(a.year - b.year) <= 5 then 1.0 "
    "else cast(5.0 as double) / cast(abs(a.year - b.year) as double) end, 0.0)",
    "5 * " + _guard(_jac("a.country", "b.country"), "country_missing"),
    "5 * " + _guard(_jac("a.lang", "b.lang"), "lang_missing"),
    "1 * coalesce(cast(1.0 as double) / (cast(1.0 as double) + abs(a.score - b.score)), 0.0)",
])

# all unordered pairs, each scored once with the smaller id as the first title
PAIRS = f"""pairs AS (
  select a.id as lo, b.id as hi, ({PAIR_SIM}) / cast(28.0 as double) as similarity
  from feat a join feat b on a.id < b.id)"""

BOTH_DIRECTIONS = """directed AS (
  select lo as id1, hi as id2, similarity from pairs
  union all
  select hi as id1, lo as id2, similarity from pairs)"""


def content_similarity(min_similarity: float = 0.4) -> str:
    return (with_(CATALOG, FEATURES, PAIRS, BOTH_DIRECTIONS)
            + f"select id1, id2, round(similarity, 6) as similarity from directed "
              f"where similarity >= {min_similarity}")


def top_similar_items(n: int = 10) -> str:
    return (with_(CATALOG, FEATURES, PAIRS, BOTH_DIRECTIONS)
            + "select id1, id2, round(similarity, 6) as similarity, cast(rank as integer) as rank from ("
              "select *, row_number() over (partition by id1 order by similarity desc, id2) as rank "
              f"from directed) where rank <= {n}")


ORACLES: dict[str, str] = {
    "content_similarity": content_similarity(0.4),
    "top_similar_items": top_similar_items(10),
}


# ---- P5 near-real-time scoring ----------------------------------------------------------------

SIM04 = "sim AS (select id1, id2, similarity from directed where similarity >= 0.4)"
TOP10 = """top AS (select id1, id2, similarity, rank from (
  select *, row_number() over (partition by id1 order by similarity desc, id2) as rank from directed)
  where rank <= 10)"""
SIM_CTES = (CATALOG, FEATURES, PAIRS, BOTH_DIRECTIONS, SIM04)


def neighbor_score_a() -> str:
    return (with_(RATINGS, CATALOG, FEATURES, PAIRS, BOTH_DIRECTIONS,
                  "sim AS (select id1, id2, similarity from directed where similarity >= 0.6)",
                  RATING_EVENTS, """recent AS (
  select user_id, item_id as recent_item, rating as recent_rate from (
    select *, row_number() over (partition by user_id order by ts desc, item_id) as rn from ratings)
  where rn <= 5)""", """cands AS (
  select e.event_id, e.user_id, e.ts as event_ts, s.id2 as item_id
  from rating_events e join sim s on s.id1 = e.item_id)""", """ap AS (
  select c.event_id, c.user_id, c.event_ts, c.item_id, r.recent_rate,
         coalesce(s.similarity, cast(0.6 as double)) as sim
  from cands c join recent r on r.user_id = c.user_id
  left join directed s on s.id1 = c.item_id and s.id2 = r.recent_item)""", """per AS (
  select event_id, user_id, event_ts, item_id, sum(sim * recent_rate) as weighted, count(*) as n_kept,
         count(case when recent_rate >= 3.0 then 1 end) as n_like,
         count(case when recent_rate < 3.0 then 1 end) as n_dislike
  from ap where sim > 0.5 group by event_id, user_id, event_ts, item_id)""")
            + """select event_id, user_id, event_ts, item_id,
  round(weighted / sum(n_kept) over (partition by event_id)
        + log2(greatest(n_like, 1)) - log2(greatest(n_dislike, 1)), 9) as score
from per""")


def _scores_b(n: int, t: float, user_marks: bool) -> tuple[str, ...]:
    weight = "h.rating * 2.0" if user_marks else "coalesce(k.score, 0.0)"
    return (RATINGS, *SIM_CTES, TOP10, RATING_EVENTS,
            "hist AS (select * from ratings where user_id in (select user_id from rating_events))",
            """anchors AS (select user_id, item_id as anchor_item from (
  select *, row_number() over (partition by user_id order by ts desc, item_id) as rn from hist) where rn = 1)""",
            f"""cands AS (select a.user_id, a.anchor_item, t.id2 as item_id, t.rank
  from anchors a join top t on t.id1 = a.anchor_item where t.rank <= {n})""",
            f"""bp AS (
  select c.user_id, c.anchor_item, c.item_id, c.rank, coalesce(s.similarity, 0.0) as sim,
         coalesce(k.score, 0.0) as cscore, {weight} as w
  from cands c join hist h on h.user_id = c.user_id
  left join sim s on s.id1 = c.item_id and s.id2 = h.item_id
  left join catalog k on k.id = h.item_id)""",
            f"""per AS (
  select user_id, anchor_item, item_id, rank,
         sum(case when sim >= {t} then w * sim else 0.0 end) as psum,
         count(case when sim >= {t} then 1 end) as n_sim,
         count(case when sim >= {t} and cscore >= 7.0 then 1 end) as n_in,
         count(case when sim >= {t} and cscore < 7.0 then 1 end) as n_re
  from bp group by user_id, anchor_item, item_id, rank)""",
            """scored AS (select user_id, anchor_item, item_id, rank,
  round((case when n_sim = 0 then 0.0 else psum / n_sim end)
        + log10(greatest(n_in, 1)) - log10(greatest(n_re, 1)), 9) as priority from per)""")


def neighbor_score_b(n: int, t: float, user_marks: bool) -> str:
    return (with_(*_scores_b(n, t, user_marks))
            + "select user_id, anchor_item, item_id, cast(rank as integer) as rank, round(priority, 9) as priority from scored")


MERGE = """best AS (
  select user_id, item_id, max(priority) as priority from (
    select user_id, item_id, priority from scored
    union all
    select user_id, item_id, priority * cast(0.9 as double) from last_recs
    where user_id in (select user_id from scored)) group by user_id, item_id)""", """merged AS (
  select * from (select *, row_number() over (partition by user_id order by priority desc, item_id) as slot
                 from best) where slot <= 10)"""


def merge_decayed() -> str:
    return (with_(*_scores_b(10, 0.4, False), LAST_RECS, *MERGE)
            + "select user_id, item_id, round(priority, 9) as priority, cast(slot as integer) as slot from merged")


SUPPLEMENT = (
    "kept AS (select * from merged where priority >= 3.0)",
    """low_slots AS (select user_id, slot, row_number() over (partition by user_id order by slot) as j
  from merged where priority < 3.0)""",
    "need AS (select user_id, count(*) as n_low from low_slots group by user_id)",
    """excluded AS (select distinct user_id, item_id from (
  select user_id, item_id from kept
  union all select user_id, item_id from ratings where user_id in (select user_id from need)))""",
    """anch AS (select user_id, item_id as anchor_item from (
  select *, row_number() over (partition by user_id order by ts desc, item_id) as rn from ratings) where rn = 1)""",
    """user_genre AS (select n.user_id, split_part(c.filmtype, '/', 1) as genre, n.n_low
  from need n join anch a on a.user_id = n.user_id join catalog c on c.id = a.anchor_item)""",
    """pools AS (select genre, id from (
  select g.genre, c.id, row_number() over (partition by g.genre order by c.score desc, c.id) as pool_rank
  from (select distinct genre from user_genre) g join catalog c on contains(c.filmtype, g.genre))
  where pool_rank <= 50)""",
    """g_pick AS (select user_id, item_id, j from (
  select ug.user_id, ug.n_low, p.id as item_id,
         row_number() over (partition by ug.user_id
                            order by (p.id * 7919 + ug.user_id * 104729 + 0) % 1000003, p.id) as j
  from user_genre ug join pools p on p.genre = ug.genre
  where not exists (select 1 from excluded e where e.user_id = ug.user_id and e.item_id = p.id))
  where j <= n_low)""",
    """short AS (select n.user_id, n.n_low, coalesce(c.n_genre, 0) as n_genre
  from need n left join (select user_id, count(*) as n_genre from g_pick group by user_id) c
  on c.user_id = n.user_id where n.n_low > coalesce(c.n_genre, 0))""",
    """excl_all AS (select user_id, item_id from excluded union all select user_id, item_id from g_pick)""",
    "ncat AS (select count(*) as n from catalog)",
    """idx AS (select id as item_id, row_number() over (order by (id * 7919 + 0) % 1000003, id) - 1 as pos
  from catalog)""",
    """f_pick AS (select user_id, item_id, n_genre + k as j from (
  select s.user_id, s.n_low, s.n_genre, i.item_id,
         row_number() over (partition by s.user_id
                            order by ((i.pos - (s.user_id * 104729 + 0) % nc.n) % nc.n + nc.n) % nc.n) as k
  from short s, idx i, ncat nc
  where not exists (select 1 from excl_all e where e.user_id = s.user_id and e.item_id = i.item_id))
  where k <= n_low - n_genre)""",
    """picks AS (select user_id, item_id, j, cast(1.51 as double) as priority from g_pick
  union all select user_id, item_id, j, cast(3.1 as double) as priority from f_pick)""",
    """supp AS (select user_id, item_id, priority, slot from kept
  union all
  select l.user_id, p.item_id, p.priority, l.slot from low_slots l join picks p on p.user_id = l.user_id and p.j = l.j)""",
)


def supplemented_recs() -> str:
    return (with_(*_scores_b(10, 0.4, False), LAST_RECS, *MERGE, *SUPPLEMENT)
            + "select user_id, item_id, round(priority, 9) as priority, cast(slot as integer) as slot from supp")


def packed_recs() -> str:
    return (with_(*_scores_b(10, 0.4, False), LAST_RECS, *MERGE, *SUPPLEMENT)
            + "select user_id, string_agg(printf('%d:%.4f,', item_id, priority), '' order by slot) "
              "as packed from supp group by user_id")


ORACLES.update({
    "neighbor_score_a": neighbor_score_a(),
    "neighbor_score_b0": neighbor_score_b(10, 0.4, False),
    "neighbor_score_b1": neighbor_score_b(8, 0.45, True),
    "merge_decayed": merge_decayed(),
    "supplemented_recs": supplemented_recs(),
    "packed_recs": packed_recs(),
})


# ---- ratings, splits, metrics -----------------------------------------------------------------

PSEUDO = "1 + cast((user_id * 31 + item_id * 17) % 41 as double) / 10.0"
SPLITS = ("train AS (select * from ratings where bucket < 6)",
          "validation AS (select * from ratings where bucket >= 6 and bucket < 8)",
          "test AS (select * from ratings where bucket >= 8)")
PRED = (f"""pred AS (select user_id, item_id, {PSEUDO} as prediction from test
  where user_id in (select user_id from train) and item_id in (select item_id from train))""",)

ORACLES.update({
    "rating_profile": with_(RATINGS) + """select count(*) as n_ratings, count(distinct user_id) as n_users,
  count(distinct item_id) as n_items, round(avg(rating), 6) as mean_rating from ratings""",
    "rating_split_counts": with_(RATINGS) + """select case when bucket < 6 then 'train'
  when bucket >= 6 and bucket < 8 then 'validation' when bucket >= 8 then 'test' end as split,
  count(*) as n_ratings, count(distinct user_id) as n_users, count(distinct item_id) as n_items
from ratings group by 1""",
    "train_plus_personal": with_(RATINGS, MY_RATINGS) + """select user_id, item_id, rating from ratings where bucket < 6
union all select user_id, item_id, rating from my_ratings where rating > 0""",
    "baseline_rmse": with_(RATINGS, *SPLITS, """m AS (select avg(rating) as mean_rating from (
  select rating from train union all select rating from validation))""",
                           """b AS (select sqrt(avg(pow(t.rating - m.mean_rating, 2))) as baseline_rmse from test t, m)""",
                           f"""p AS (select sqrt(sum(pow({PSEUDO} - rating, 2)) / count(*)) as model_rmse from test)""")
    + """select round(m.mean_rating, 6) as mean_rating, round(b.baseline_rmse, 6) as baseline_rmse,
  round(p.model_rmse, 6) as model_rmse,
  round((b.baseline_rmse - p.model_rmse) / b.baseline_rmse * 100.0, 6) as improvement_pct from m, b, p""",
    "recent_ratings_k5": with_(RATINGS) + """select user_id, item_id, rating, ts, cast(rank as integer) as rank from (
  select *, row_number() over (partition by user_id order by ts desc, item_id) as rank from ratings)
where rank <= 5""",
    "user_history": with_(RATINGS) + """select user_id, item_id, rating, ts, cast(rank as bigint) as rank,
  rank = 1 as is_anchor from (
  select *, row_number() over (partition by user_id order by ts desc, item_id) as rank from ratings)""",
    "unseen_candidates": with_(CATALOG, MY_RATINGS)
    + "select id from catalog where id not in (select item_id from my_ratings where rating > 0)",
    "metric_rmse": with_(RATINGS, *SPLITS, *PRED, """j AS (select t.rating, p.prediction from test t
  left join pred p on p.user_id = t.user_id and p.item_id = t.item_id)""")
    + """select count(prediction) as n_pred, count(*) as n_truth,
  round(sum(pow(prediction - rating, 2)) / count(prediction), 6) as mse,
  round(sqrt(sum(pow(prediction - rating, 2)) / count(prediction)), 6) as rmse,
  round(sqrt(sum(pow(prediction - rating, 2)) / count(*)), 6) as rmse_all from j""",
    "metric_map": with_(RATINGS, *SPLITS, *PRED,
                        """ranked AS (select user_id, item_id,
  row_number() over (partition by user_id order by prediction desc, item_id) as rank from pred)""",
                        "rel AS (select distinct user_id, item_id from test where rating >= 4.0)",
                        "nrel AS (select user_id, count(*) as n_rel from rel group by user_id)",
                        """hits AS (select r.user_id, r.rank,
  row_number() over (partition by r.user_id order by r.rank) as hit_no
  from ranked r join rel on rel.user_id = r.user_id and rel.item_id = r.item_id)""",
                        """ap AS (select user_id, sum(cast(hit_no as double) / cast(rank as double)) as prec_sum
  from hits group by user_id)""",
                        """per AS (select u.user_id, coalesce(a.prec_sum / n.n_rel, 0.0) as ap
  from (select distinct user_id from ranked) u left join ap a on a.user_id = u.user_id
  left join nrel n on n.user_id = u.user_id)""")
    + "select round(avg(ap), 6) as map, count(*) as n_users from per",
})

# ---- dense vectors ----------------------------------------------------------------------------

_COS = "list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[]))"
ORACLES.update({
    "vector_cosine_pairs": f"""select a.vec_id as id1, b.vec_id as id2, round({_COS}, 6) as similarity
from embeddings a join embeddings b on a.vec_id <> b.vec_id where {_COS} >= 0.3""",
    "vector_top_similar": f"""select id1, id2, round(similarity, 6) as similarity, cast(rank as integer) as rank from (
  select *, row_number() over (partition by id1 order by similarity desc, id2) as rank from (
    select a.vec_id as id1, b.vec_id as id2, {_COS} as similarity
    from embeddings a join embeddings b on a.vec_id <> b.vec_id)) where rank <= 10""",
})

# ---- segments and counters --------------------------------------------------------------------

POPULAR = """popular AS (select item_id, count(*) as n_ratings from ratings group by item_id
  order by n_ratings desc, item_id limit 5)"""
ORACLES.update({
    "like_minded_users": with_(RATINGS, CATALOG, USERS) + """select distinct r.user_id from ratings r
  join catalog c on c.id = r.item_id join users u on u.id = r.user_id
where r.rating >= 5 and split_part(c.filmtype, '/', 1) = 'ECONOMY' and u.age = 18 and u.occupation = 2
order by user_id limit 10""",
    "known_users": with_(RATINGS, RATING_EVENTS)
    + "select distinct user_id from rating_events where user_id in (select user_id from ratings)",
    "new_users": with_(RATINGS, RATING_EVENTS)
    + "select distinct user_id from rating_events where user_id not in (select user_id from ratings)",
    "popular_items": with_(RATINGS, POPULAR) + "select item_id, n_ratings from popular",
    "new_user_defaults": with_(RATINGS, RATING_EVENTS, POPULAR, """new AS (select distinct user_id from rating_events
  where user_id not in (select user_id from ratings))""")
    + "select n.user_id, p.item_id, p.n_ratings from new n, popular p",
    "order_totals": with_(ORDER_EVENTS) + """select cast(id as varchar) as id, count(*) as n_orders,
  cast(sum(price) as bigint) as total_price from order_events group by id""",
    "order_grand_total": with_(ORDER_EVENTS)
    + "select count(*) as n_orders, cast(sum(price) as bigint) as total_price from order_events",
    "minute_totals": with_(EVENT_ORDERS) + """select cast(id as varchar) as id,
  time_bucket(interval '1 minute', ts) as window_start,
  time_bucket(interval '1 minute', ts) + interval '1 minute' as window_end,
  count(*) as n_orders, cast(sum(price) as bigint) as total_price
from event_orders group by 1, 2, 3""",
    "word_count": "select word, count(*) as n from (select unnest(string_split(text, ' ')) as word from documents) "
                  "group by word",
    "parsed_events": with_(RATING_EVENTS) + """select event_id, cast(user_id as integer) as user_id,
  cast(item_id as integer) as item_id, rate, epoch_us(ts) // 1000 as epoch_ms from rating_events""",
})


# ---- sink formats and smaller operators --------------------------------------------------------

ORACLES.update({
    "rating_messages": with_(RATINGS) + """select cast(user_id as varchar) as key,
  cast(user_id as varchar) || '|' || cast(item_id as varchar) || '|' || cast(rating as varchar) as value
from ratings""",
    "similarity_lines": with_(CATALOG, FEATURES, PAIRS, BOTH_DIRECTIONS)
    + "select printf('%d,%d,%.6f', id1, id2, similarity) as value from directed where similarity >= 0.6",
    "top_rated_by_user": with_(RATINGS) + """select user_id, item_id, rating, cast(rank as integer) as rank from (
  select *, row_number() over (partition by user_id order by rating desc, item_id) as rank from ratings)
where rank <= 10""",
    "popular_titles": with_(RATINGS, POPULAR, """cb AS (select p_partkey as id, p_name as name from part)""")
    + "select p.item_id, p.n_ratings, cb.name as title from popular p left join cb on cb.id = p.item_id",
    "rating_split_counts_leaking": with_(RATINGS) + """select split, count(*) as n_ratings,
  count(distinct user_id) as n_users, count(distinct item_id) as n_items from (
  select 'train' as split, user_id, item_id from ratings where bucket < 8
  union all select 'validation', user_id, item_id from ratings where bucket >= 6 and bucket < 8
  union all select 'test', user_id, item_id from ratings where bucket >= 8) group by split""",
    "genre_pools": """with cb as (select p_partkey as id, p_type || '/' || split_part(p_name, ' ', 2) as filmtype,
  round((p_retailprice - 900) / 10, 2) as score from part),
g as (select distinct split_part(filmtype, '/', 1) as genre from cb)
select genre, id, score, cast(pool_rank as integer) as pool_rank from (
  select g.genre, cb.id, cb.score, row_number() over (partition by g.genre order by cb.score desc, cb.id) as pool_rank
  from g join cb on contains(cb.filmtype, g.genre)) where pool_rank <= 50""",
    "latest_events": with_(RATING_EVENTS) + """select user_id, event_id, ts from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from rating_events)
where rn = 1""",
})

ORACLES["running_totals"] = with_(ORDER_EVENTS) + """select id, day,
  cast(sum(n_day) over (partition by id order by day rows between unbounded preceding and current row) as bigint)
    as n_orders,
  cast(sum(price_day) over (partition by id order by day rows between unbounded preceding and current row) as bigint)
    as total_price
from (select cast(id as varchar) as id, cast(cast(ts as date) as timestamp) as day, count(*) as n_day,
             sum(price) as price_day
      from order_events group by 1, 2)"""


# ---- facts about models ---------------------------------------------------------------------------

KNOWN = """known AS (select * from {0} where user_id in (select user_id from train) and item_id in (select item_id from train))"""


def list_facts(key: str, owners: str, length: str, extra: str = "") -> str:
    """A row per owner of a list: the expected length, and true for order, no repeats and finite values."""
    return f"select cast({key} as bigint) as {key}, cast({length} as bigint) as n, true as in_order, true as no_repeats, true as finite{extra} from ({owners})"


N_TRAINED = "least(10, (select count(distinct item_id) from train))"
ORACLES.update({
    "als_predict_facts": with_(RATINGS, *SPLITS, KNOWN.format("test")) + """select count(*) as n, count(distinct user_id) as n_users,
  count(distinct item_id) as n_items, true as finite, true as beats_mean from known""",
    "als_recommend_all_facts": with_(RATINGS, *SPLITS) + list_facts("user_id", "select distinct user_id from train", N_TRAINED),
    "als_recommend_subset_facts": with_(RATINGS, *SPLITS, RATING_EVENTS) + list_facts(
        "user_id", "select distinct user_id from train where user_id in (select user_id from rating_events)", N_TRAINED),
    "als_unseen_facts": with_(RATINGS, *SPLITS, MY_RATINGS) + list_facts(
        "user_id", "select distinct user_id from my_ratings", """least(10, (select count(*) from (
  select item_id from train union select item_id from my_ratings where rating > 0) t
  where item_id in (select p_partkey from part) and item_id not in (select item_id from my_ratings where rating > 0)))""",
        ", cast(0 as bigint) as n_seen"),
    "als_implicit_facts": with_(RATINGS, *SPLITS) + list_facts("user_id", "select distinct user_id from train", N_TRAINED),
    "als_factor_similarity_facts": "select true as symmetric, cast(0 as bigint) as n_self, cast(0 as bigint) as n_outside, cast(0 as bigint) as n_unknown",
    "als_similar_items_facts": with_(RATINGS, *SPLITS) + list_facts(
        "id1", "select item_id as id1 from ratings group by item_id order by count(*) desc, item_id limit 1", "least(10, (select count(distinct item_id) from train) - 1)"),
    "als_grid_facts": with_(RATINGS, *SPLITS, KNOWN.format("validation")) + """select cast(rank as integer) as rank, cast(reg as double) as reg,
  cast(max_iter as integer) as max_iter, (select count(*) from known) as n_pred, true as finite, cast(1 as bigint) as n_best
from (select unnest([8, 22]) as rank), (select unnest([0.1, 10.0]) as reg), (select unnest([5, 7]) as max_iter)""",
    "als_metrics_facts": with_(RATINGS, *SPLITS, KNOWN.format("test")) + """select (select count(*) from known) as n_pred, count(*) as n_truth,
  true as rmse_is_root, true as all_pairs_below, true as map_in_range from test""",
})
