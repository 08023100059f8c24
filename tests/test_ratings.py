"""Distinct counts by bitmaps, the gap-based filler, bucketed tables."""

import random

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tastespark import fixtures
from tastespark.operators import neighbors, ratings
from tastespark.plans.bucketed import bucketed
from tastespark.plans.materialize import dropped_after


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_equal_sets(make):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, *range(40), 10 ** 6, 2 ** 31 - 1, -5]), rnd.choice([None, 7, 32767, 32768, 32769]), rnd.choice([None, 1.0, 4.0]),
             rnd.randrange(10)) for _ in range(500)]
    df = make(rows, "user_id long, item_id long, rating double, bucket long")
    r = ratings.rating_profile(df).first()
    rated = [x[2] for x in rows if x[2] is not None]
    assert (r.n_ratings, r.n_users, r.n_items) == (500, len({x[0] for x in rows} - {None}), 4)
    assert r.mean_rating == pytest.approx(sum(rated) / len(rated))
    for r in ratings.split_counts(df, ratings.SPLITS_LEAKING).collect():
        lo, hi = ratings.SPLITS_LEAKING[r.split]
        mine = [x for x in rows if (lo is None or x[3] >= lo) and (hi is None or x[3] < hi)]
        assert (r.n_ratings, r.n_users, r.n_items) == (len(mine), len({x[0] for x in mine} - {None}), len({x[1] for x in mine} - {None}))
    empty = ratings.rating_profile(make([], "user_id long, item_id long, rating double, bucket long")).first()
    assert tuple(empty) == (0, 0, 0, None)


def test_no_expand_in_the_plan(spark):
    df = fixtures.ratings(spark, SF001)
    assert "Expand" not in plan(ratings.rating_profile(df)) and "Expand" not in plan(ratings.split_counts(df))


def plain_filler(short, taken, items, seed):
    order = sorted(items, key=lambda i: ((i * neighbors.HASH_ITEM + seed) % neighbors.HASH_MOD, i))
    out = []
    for user, n_low, n_genre in short:
        at, got = (user * neighbors.HASH_USER + seed) % len(order), []
        for s in range(len(order)):
            item = order[(at + s) % len(order)]
            if item not in taken.get(user, ()) and len(got) < n_low - n_genre:
                got.append(item)
        out += [(user, item, n_genre + j + 1) for j, item in enumerate(got)]
    return sorted(out)


@pytest.mark.parametrize("seed", [0, 5])
def test_filler_takes_the_first_free_places(make, seed):
    """Users with nothing taken, nearly all taken, all taken, and items taken that the catalog does not have."""
    rnd, items = random.Random(seed), list(range(3, 63))
    taken = {1: set(), 2: set(rnd.sample(items, 55)), 3: set(items), 4: set(rnd.sample(items, 30)) | {999, 1000}, 5: {items[0]}}
    short = [(u, 8, u % 3) for u in (1, 2, 3, 4, 5)]
    excl = make([(u, i) for u, some in taken.items() for i in some], "user_id long, item_id long")
    cat = make([(i, 1.0, "G") for i in items], "id long, score double, filmtype string")
    frame = make(short, "user_id long, n_low long, n_genre long")
    got = neighbors._catalog_filler(frame, excl, cat, seed)
    assert sorted(tuple(r) for r in got.collect()) == plain_filler(short, taken, items, seed)


def test_filler_makes_as_many_rows_as_are_needed(spark, make):
    """A user with a long history: what is joined with the catalog's order is the missing places alone."""
    cat = spark.range(5000).select("id", F.lit(1.0).alias("score"), F.lit("G").alias("filmtype"))
    excl = spark.range(4900).select(F.lit(9).cast("bigint").alias("user_id"), F.col("id").alias("item_id"))
    got = neighbors._catalog_filler(make([(9, 4, 1)], "user_id long, n_low long, n_genre long"), excl, cat, 0)
    assert got.count() == 3
    assert "sequence(0, (need" in plan(got).replace("cast(need", "need") or "Generate explode(sequence(0" in plan(got)


def test_bucketed_side_is_not_shuffled_again(spark, make):
    with dropped_after(spark):
        hist = bucketed(fixtures.ratings(spark, SF001).select("user_id", "item_id", "rating", "ts"), "history", "user_id")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            users = make([(1,), (4,), (5,)], "user_id long")
            joined = hist.join(users, "user_id")
            both = plan(joined)
            assert both.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in both
            counted = hist.groupBy("user_id").agg(F.max("ts"))
            assert "Exchange" not in plan(counted)
            assert "Exchange" not in plan(ratings.latest_rating(hist))
            want = fixtures.ratings(spark, SF001).join(users, "user_id").count()
            assert joined.count() == want
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("history_")] == []
