"""Rating-table operators: bucket split (PR5, PR6, RC4), unions (ST1, ST2),
counts (AG1-AG3), latest-K and history windows (WN1, WN2), seen-item
restriction (JN9) and distinct ids (ST4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.indexing import row_number_unbounded
from ..plans.topk import top_k_per_group

# Bucket bounds of the three-way split (bucket = time % 10).
SPLITS_DEFAULT = {"train": (None, 6), "validation": (6, 8), "test": (8, None)}
# The leaking variant: training is bucket < 8 while validation is 6..7.
SPLITS_LEAKING = {"train": (None, 8), "validation": (6, 8), "test": (8, None)}


def time_bucket(ts_seconds: Column, buckets: int = 10) -> Column:
    """PR5: ``ts % 10`` on an integer time."""
    return F.pmod(ts_seconds, F.lit(buckets))


def split_predicate(bucket: Column, bounds: tuple) -> Column:
    lo, hi = bounds
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (bucket >= lo)
    if hi is not None:
        cond = cond & (bucket < hi)
    return cond


def split_ratings(ratings: DataFrame, splits: dict | None = None) -> dict[str, DataFrame]:
    """RC4 / PR6: named splits as filters over the ``bucket`` column (no shuffle)."""
    splits = splits or SPLITS_DEFAULT
    return {name: ratings.filter(split_predicate(F.col("bucket"), b)) for name, b in splits.items()}


def split_label(bucket: Column, splits: dict | None = None) -> Column:
    splits = splits or SPLITS_DEFAULT
    expr = None
    for name, b in splits.items():
        expr = (F.when(split_predicate(bucket, b), F.lit(name)) if expr is None
                else expr.when(split_predicate(bucket, b), F.lit(name)))
    return expr


def id_counts(ratings: DataFrame, *groups: str) -> DataFrame:
    """AG2 / ST4: rows, distinct users and distinct items (and the ratings' sum and number) of each group, exactly, from
    bitmaps: a map task sends one bitmap for each 32,768 neighbouring ids that it meets instead of every id.
    Ids fit the int range (ALS), so that a group has at most 65,536 bitmaps of a kind."""
    user = F.struct(F.lit(0).alias("kind"), F.col("user_id").cast("bigint").alias("id"), F.col("rating").cast("double").alias("rating"))
    item = F.struct(F.lit(1).alias("kind"), F.col("item_id").cast("bigint").alias("id"), F.lit(None).cast("double").alias("rating"))
    rows = ratings.select(*groups, F.explode(F.array(user, item)).alias("_r")).select(*groups, "_r.*")
    per = rows.groupBy(*groups, "kind", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("id"))).alias("ids"),
        F.count(F.lit(1)).alias("n"), F.count("rating").alias("rated"), F.sum("rating").alias("total"))
    users, items = F.col("kind") == 0, F.col("kind") == 1

    def total(which: Column, c: str) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col(c))), F.lit(0)).cast("bigint")

    sums = [total(users, "n").alias("n_ratings"), total(users, "ids").alias("n_users"), total(items, "ids").alias("n_items"),
            F.sum("total").alias("sum_rating"), F.sum("rated").alias("n_rated")]
    return per.groupBy(*groups).agg(*sums)


def rating_profile(ratings: DataFrame) -> DataFrame:
    """AG1-AG3: rows, distinct users, distinct items, mean rating (one row)."""
    return id_counts(ratings).select("n_ratings", "n_users", "n_items", F.try_divide("sum_rating", "n_rated").alias("mean_rating"))


def split_labels(bucket: Column, splits: dict | None = None) -> Column:
    """Every split a bucket belongs to (splits may overlap, as in the leaking option)."""
    splits = splits or SPLITS_DEFAULT
    arr = F.array(*[F.when(split_predicate(bucket, b), F.lit(name)) for name, b in splits.items()])
    return F.filter(arr, lambda x: x.isNotNull())


def split_counts(ratings: DataFrame, splits: dict | None = None) -> DataFrame:
    """AG1 / AG2 per split in one pass: each row is labelled with every split it
    belongs to, then counted."""
    lab = ratings.select(F.explode(split_labels(F.col("bucket"), splits)).alias("split"), "user_id", "item_id",
                         F.lit(None).cast("double").alias("rating"))
    return id_counts(lab, "split").select("split", "n_ratings", "n_users", "n_items")


def positive_personal(personal: DataFrame) -> DataFrame:
    """SRC5 filter: keep ratings above 0."""
    return personal.filter(F.col("rating") > 0)


def assert_not_empty(df: DataFrame, what: str) -> DataFrame:
    """SRC5 check: fail when nothing is left (``limit(1)`` keeps the probe cheap)."""
    if df.limit(1).count() == 0:
        raise ValueError(f"no {what} left after filtering")
    return df


def with_personal(train: DataFrame, personal: DataFrame) -> DataFrame:
    """ST1: training ratings plus the user's own positive ratings."""
    cols = ["user_id", "item_id", "rating"]
    return train.select(*cols).unionByName(positive_personal(personal).select(*cols))


def recent_ratings(history: DataFrame, k: int = 5) -> DataFrame:
    """WN1: the latest ``k`` ratings of every user (ties on time go to the smaller item)."""
    return top_k_per_group(history, ["user_id"], [F.col("ts").desc(), F.col("item_id").asc()], k, "rank")


def latest_rating(history: DataFrame) -> DataFrame:
    """WN2 anchor: each user's newest rating, as an aggregate (map-side partial, skew safe)."""
    m = F.max(F.struct(F.col("ts"), (-F.col("item_id")).alias("neg_item"), F.col("item_id"), F.col("rating")))
    return history.groupBy("user_id").agg(m.alias("m")).select(
        "user_id", F.col("m.item_id").alias("anchor_item"), F.col("m.ts").alias("anchor_ts"))


def user_history(history: DataFrame) -> DataFrame:
    """WN2: every rating of a user numbered newest first (ties on time to the
    smaller item); rank 1 is the anchor.

    The numbering is a distributed row number (range-partitioned sort plus
    per-partition offsets), so no single task sorts a hot user's whole history.
    """
    ranked = row_number_unbounded(history, ["user_id"], [F.col("ts").desc(), F.col("item_id").asc()], "rank")
    return ranked.withColumn("is_anchor", F.col("rank") == 1)


def unrated_items(catalog_ids: DataFrame, rated: DataFrame, user_id: int | None = None,
                  keep_rated: bool = False) -> DataFrame:
    """JN9: catalog items the user has not rated (anti join); ``keep_rated`` gives the
    as-is behaviour of keeping only rated ones (semi join)."""
    r = rated if user_id is None else rated.filter(F.col("user_id") == user_id)
    r = r.select(F.col("item_id").alias("id"))
    return catalog_ids.join(r, "id", "left_semi" if keep_rated else "left_anti")


def distinct_ids(df: DataFrame, col: str) -> DataFrame:
    """ST4: distinct values of one column."""
    return df.select(col).distinct()


def user_ratings(ratings: DataFrame, user_id: int) -> DataFrame:
    """PR11: one user's ratings (the filter reaches the scan as a pushed predicate)."""
    return ratings.filter(F.col("user_id") == user_id)


def add_columns(df: DataFrame, a: str, b: str, out: str = "total") -> DataFrame:
    """PR4: arithmetic projection ``a + b``."""
    return df.select("*", (F.col(a) + F.col(b)).alias(out))


def sort_scored(df: DataFrame, col: str = "score", ascending: bool = True) -> DataFrame:
    """TK3: full sort of scored rows (range-partitioned, distributed)."""
    return df.orderBy(F.col(col).asc() if ascending else F.col(col).desc(), *[c for c in df.columns if c != col])
