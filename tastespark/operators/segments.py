"""User segments and counters: RC13, RC19, JN4, JN10, PR9, AG10, AG12, AG13, SC13."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_token, json_field
from ..plans.topk import top_k_per_group


def like_minded_users(ratings: DataFrame, catalog: DataFrame, users: DataFrame, genre: str,
                      min_rating: float = 5.0, age: int = 18, occupation: int = 2,
                      limit: int | None = 10) -> DataFrame:
    """RC13 / JN4 / PR9 / AG13: users of a given age and occupation who rated an
    item of ``genre`` (first genre token) at least ``min_rating``; distinct ids,
    the first ``limit`` by id.  Filters run before the star join, so both
    dimension sides shrink before any shuffle."""
    items = catalog.filter(first_token(F.col("filmtype")) == genre).select(F.col("id").alias("item_id"))
    people = users.filter((F.col("age") == age) & (F.col("occupation") == occupation)) \
                  .select(F.col("id").alias("user_id"))
    r = ratings.filter(F.col("rating") >= min_rating).select("user_id", "item_id")
    ids = r.join(items, "item_id", "left_semi").join(people, "user_id", "left_semi").select("user_id").distinct()
    return ids.orderBy("user_id").limit(limit) if limit else ids


def split_users(events: DataFrame, ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JN10: (known, new) distinct event users, by semi / anti join with rated users."""
    ev = events.select("user_id").distinct()
    rated = ratings.select("user_id")
    return ev.join(rated, "user_id", "left_semi"), ev.join(rated, "user_id", "left_anti")


def popular_items(ratings: DataFrame, k: int = 5) -> DataFrame:
    """RC19: the ``k`` most rated items (ties to the smaller id), a fallback for new users."""
    counts = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_ratings"))
    return counts.orderBy(F.col("n_ratings").desc(), F.col("item_id").asc()).limit(k)


def default_for_new_users(new_users: DataFrame, popular: DataFrame) -> DataFrame:
    """RC19 routing: every new user gets the popular list.  The list is ``k`` rows
    (a proven bound), packed into one array by a scalar subquery and exploded per
    user, so no join is needed."""
    lst = popular.agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("n_ratings")).alias("neg_n"),
        F.col("item_id"), F.col("n_ratings"))))).scalar()
    return new_users.select("user_id", F.explode(lst).alias("p")).select(
        "user_id", F.col("p.item_id").alias("item_id"), F.col("p.n_ratings").alias("n_ratings"))


def parse_orders(payloads: DataFrame, value_col: str = "value") -> DataFrame:
    """SC13: ``{"id": "...", "price": n}`` text to (id, price)."""
    return payloads.select(json_field(F.col(value_col), "id").alias("id"),
                           json_field(F.col(value_col), "price").try_cast("bigint").alias("price"),
                           *[c for c in payloads.columns if c != value_col])


def order_totals(orders: DataFrame) -> DataFrame:
    """AG10: per id count and sum of price (partial aggregation before the shuffle)."""
    return orders.groupBy("id").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("price").alias("total_price"))


def grand_total(orders: DataFrame) -> DataFrame:
    """STR5 grand total: one global aggregate."""
    return orders.agg(F.count(F.lit(1)).alias("n_orders"), F.sum("price").alias("total_price"))


def minute_totals(orders: DataFrame, ts_col: str = "ts", window: str = "1 minute") -> DataFrame:
    """STR6: per id and time window, count and sum of price."""
    w = F.window(F.col(ts_col), window)
    return orders.groupBy(F.col("id"), w.alias("w")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("price").alias("total_price")).select(
        "id", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n_orders", "total_price")


def word_count(texts: DataFrame, text_col: str = "text", sep: str = " ") -> DataFrame:
    """AG12: split every whole text on ``sep``, count each word."""
    words = texts.select(F.explode(F.split(F.col(text_col), sep)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def first_ratings_per_user(ratings: DataFrame, k: int) -> DataFrame:
    """TK2: ``k`` ratings of one user, highest rating first."""
    return top_k_per_group(ratings, ["user_id"], [F.col("rating").desc(), F.col("item_id").asc()], k, "rank")


def attach_titles(df: DataFrame, titles: DataFrame, id_col: str = "item_id") -> DataFrame:
    """JN5: title lookup as a join.  Only titles of ids that occur are joined: the
    semi join's build side is the distinct ids of ``df``, usually a short list."""
    t = titles.select(F.col("id").alias(id_col), F.col("name").alias("title"))
    needed = t.join(df.select(id_col).distinct(), id_col, "left_semi")
    return df.join(needed, id_col, "left")


def running_totals_by_day(orders: DataFrame, ts_col: str = "ts") -> DataFrame:
    """STR4 batch equivalent: per product and day, the cumulative count and price
    through that day -- the state a day-batched stream holds after each batch.
    Orders are pre-aggregated per (product, day) first; the running window then
    holds one row per day of one product (bounded by the calendar span)."""
    from pyspark.sql import Window

    daily = orders.groupBy("id", F.to_date(F.col(ts_col)).cast("timestamp_ntz").alias("day")).agg(
        F.count(F.lit(1)).alias("n_day"), F.sum("price").alias("price_day"))
    w = Window.partitionBy("id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("id", "day", F.sum("n_day").over(w).alias("n_orders"),
                        F.sum("price_day").over(w).alias("total_price"))
