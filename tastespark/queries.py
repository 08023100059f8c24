"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the whole input tables.

Column names match the oracle SQL in ``oracle.py``; doubles are rounded to 6
decimals only here, at the output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import fixtures
from .functions import text as text_fn
from .io import table
from .operators import content, content_lists, factors, metrics, neighbors, segments, vectors
from .operators import ratings as ratings_ops
from .plans.bucketed import bucketed
from .plans.materialize import stored
from .session import ensure_checkpoint_dir, ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return fn(spark, sf_dir)
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        REGISTRY[name] = wrapped
        return wrapped
    return deco


def r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


def r9(c: str) -> F.Column:
    """Scores that are ranked and compared with cuts are fixed to 9 digits inside the
    operators; rounding them again to 6 would create half-way ties that engines
    break differently, so they are emitted at 9 digits."""
    return F.round(F.col(c), 9).alias(c)


# ---- P1 content similarity ----------------------------------------------------------------------

@register("content_similarity")
def q_content_similarity(spark, sf_dir):
    """RC12 / JN1 / SC1-SC8 / PR8: item pairs with similarity >= 0.4, both directions."""
    cat = fixtures.catalog(spark, sf_dir)
    s = content.content_similarity(cat, min_similarity=0.4)
    return s.select("id1", "id2", r6("similarity"))


@register("top_similar_items")
def q_top_similar_items(spark, sf_dir):
    """WN3: the 10 most similar items of every item over all pairs (exact)."""
    cat = fixtures.catalog(spark, sf_dir)
    s = content.content_similarity(cat, min_similarity=None, top_n=10)
    return s.select("id1", "id2", r6("similarity"), "rank")


# ---- P5 near-real-time scoring, batch form -----------------------------------------------------

# threshold of the similar-items table written by the batch job, from which variant A takes its candidates
SIMILAR_TABLE_THRESHOLD = 0.6


def _features(spark, sf_dir):
    """Item features, as they are and as numbers, written once: the candidate search and the pair scorer read them."""
    feats = stored(content.item_features(fixtures.catalog(spark, sf_dir)), "features")
    return feats, stored(content_lists.coded_features(feats), "coded-features")


def _history(spark, sf_dir):
    """The ratings view, written once per query (it is read by several branches:
    anchors, history pairs, exclusions), instead of re-joining lineitem and
    orders for each branch; bucketed by user, so that none of them shuffles it again."""
    return bucketed(fixtures.ratings(spark, sf_dir).select("user_id", "item_id", "rating", "ts"), "history", "user_id")


def _ratings_once(spark, sf_dir):
    """The ratings view with its bucket, written once for queries whose splits read
    it in several branches (train, validation, test)."""
    return stored(fixtures.ratings(spark, sf_dir), "ratings")


def _scores_b(spark, sf_dir, params, hist=None):
    ev = fixtures.rating_events(spark, sf_dir).select("user_id")
    hist = _history(spark, sf_dir) if hist is None else hist
    feats, coded = _features(spark, sf_dir)
    # candidates: the anchors of the users with an event against the catalog, scored with the users' histories
    anchors = ratings_ops.latest_rating(hist.join(ev.distinct(), "user_id", "left_semi"))
    top = content_lists.top_similar(feats, coded, params["n"], asked=anchors.select(F.col("anchor_item").alias("id")))
    return neighbors.neighbor_score_b(ev, hist, top, None, fixtures.catalog_basic(spark, sf_dir), n=params["n"],
                                      min_similarity=params["min_similarity"],
                                      score_cut=params["score_cut"], score_source=params["score_source"],
                                      by_user=lambda cands, rated, least: content_lists.score_by_user(cands, rated, coded, least))


@register("neighbor_score_a")
def q_neighbor_score_a(spark, sf_dir):
    """RC14 / JN6-JN8 / AG8 / WN1 / SC10: variant A scores of every rating event.

    Candidates are the items of the similar-items table (similarity >= 0.6, RC10, Q25) of the
    event's item; pair similarities are looked up exactly, and 0.6 stands only
    for pairs that have none (an item with itself, or outside the catalog)."""
    _, coded = _features(spark, sf_dir)
    ev = fixtures.rating_events(spark, sf_dir)
    similar = content_lists.similar_above(coded, ev.select(F.col("item_id").alias("id")), SIMILAR_TABLE_THRESHOLD)
    out = neighbors.neighbor_score_a(ev, fixtures.ratings(spark, sf_dir), similar,
                                     by_item=lambda cands, recent, least: content_lists.score_by_item(cands, recent, coded, least),
                                     known=coded.select("id"), **neighbors.VARIANT_A)
    return out.select("event_id", "user_id", "event_ts", "item_id", r9("score"))


@register("neighbor_score_b0")
def q_neighbor_score_b0(spark, sf_dir):
    """RC15 / WN2 / WN3 / JN6: variant B0 priorities for every user with an event."""
    return _scores_b(spark, sf_dir, neighbors.VARIANT_B0).select(
        "user_id", "anchor_item", "item_id", "rank", r9("priority"))


@register("neighbor_score_b1")
def q_neighbor_score_b1(spark, sf_dir):
    """RC16: variant B1 (user marks, N = 8, similarity >= 0.45)."""
    return _scores_b(spark, sf_dir, neighbors.VARIANT_B1).select(
        "user_id", "anchor_item", "item_id", "rank", r9("priority"))


def _merged(spark, sf_dir, hist=None):
    now = _scores_b(spark, sf_dir, neighbors.VARIANT_B0, hist)
    return neighbors.merge_decayed(now, fixtures.last_recs(spark, sf_dir), n=neighbors.VARIANT_B0["n"])


@register("merge_decayed")
def q_merge_decayed(spark, sf_dir):
    """RC17 / TK4 / SC16: B0 list merged with the decayed last list, best 10 per user."""
    return _merged(spark, sf_dir).select("user_id", "item_id", r9("priority"), "slot")


def _supplemented(spark, sf_dir):
    hist = _history(spark, sf_dir)
    merged = _merged(spark, sf_dir, hist)
    anchors = ratings_ops.latest_rating(hist)
    return neighbors.supplement(merged, anchors, fixtures.catalog_basic(spark, sf_dir), hist)


@register("supplemented_recs")
def q_supplemented_recs(spark, sf_dir):
    """RC18 / WN5 / TK5 / SC12 / PR10: low-priority slots refilled."""
    return _supplemented(spark, sf_dir).select("user_id", "item_id", r9("priority"), "slot")


@register("packed_recs")
def q_packed_recs(spark, sf_dir):
    """SNK4 format: one packed ``item:priority,`` string per user."""
    return neighbors.pack_recommendations(_supplemented(spark, sf_dir))


# ---- ratings, splits, metrics -----------------------------------------------------------------

@register("rating_profile")
def q_rating_profile(spark, sf_dir):
    """AG1-AG3: rows, distinct users and items, mean rating."""
    return ratings_ops.rating_profile(fixtures.ratings(spark, sf_dir)).select(
        "n_ratings", "n_users", "n_items", r6("mean_rating"))


@register("rating_split_counts")
def q_rating_split_counts(spark, sf_dir):
    """PR5 / PR6 / RC4 / AG1 / AG2: the three-way bucket split, counted per split."""
    return ratings_ops.split_counts(fixtures.ratings(spark, sf_dir))


@register("train_plus_personal")
def q_train_plus_personal(spark, sf_dir):
    """ST1 / SRC5: training split plus the personal ratings above 0."""
    train = ratings_ops.split_ratings(fixtures.ratings(spark, sf_dir))["train"]
    return ratings_ops.with_personal(train, fixtures.my_ratings(spark, sf_dir))


@register("baseline_rmse")
def q_baseline_rmse(spark, sf_dir):
    """AG6 / ST2: mean of train + validation as the prediction for the test split;
    the pseudo-prediction's RMSE gives the improvement."""
    sp = ratings_ops.split_ratings(_ratings_once(spark, sf_dir))
    fit = sp["train"].unionByName(sp["validation"])
    base = metrics.baseline_rmse(fit, sp["test"])
    pred = sp["test"].select("user_id", "item_id",
                             metrics.pseudo_prediction(F.col("user_id"), F.col("item_id")).alias("prediction"))
    model_rmse = metrics.error_metrics(pred, sp["test"]).select("rmse").scalar()
    return base.select(
        r6("mean_rating"), r6("baseline_rmse"), F.round(model_rmse, 6).alias("model_rmse"),
        F.round(metrics.improvement_pct(F.col("baseline_rmse"), model_rmse), 6).alias("improvement_pct"))


@register("recent_ratings_k5")
def q_recent_ratings_k5(spark, sf_dir):
    """WN1: latest five ratings of every user."""
    return ratings_ops.recent_ratings(fixtures.ratings(spark, sf_dir), 5).select(
        "user_id", "item_id", "rating", "ts", "rank")


@register("user_history")
def q_user_history(spark, sf_dir):
    """WN2: all ratings of every user with the newest (anchor) flagged."""
    return ratings_ops.user_history(fixtures.ratings(spark, sf_dir).drop("bucket"))


@register("unseen_candidates")
def q_unseen_candidates(spark, sf_dir):
    """JN9: catalog items the personal user has not rated."""
    cat = fixtures.catalog_basic(spark, sf_dir).select("id")
    mine = ratings_ops.positive_personal(fixtures.my_ratings(spark, sf_dir))
    return ratings_ops.unrated_items(cat, mine, fixtures.PERSONAL_USER_ID)


def _pseudo_predictions(spark, sf_dir):
    sp = ratings_ops.split_ratings(_ratings_once(spark, sf_dir))
    train, test = sp["train"], sp["test"]
    # like ALS with coldStartStrategy="drop": no prediction for ids unseen in training
    known = test.join(train.select("user_id").distinct(), "user_id", "left_semi") \
                .join(train.select("item_id").distinct(), "item_id", "left_semi")
    pred = known.select("user_id", "item_id",
                        metrics.pseudo_prediction(F.col("user_id"), F.col("item_id")).alias("prediction"))
    return pred, test


@register("metric_rmse")
def q_metric_rmse(spark, sf_dir):
    """AG4 / AG5 / AG7 / JN3 on the deterministic pseudo-prediction."""
    pred, test = _pseudo_predictions(spark, sf_dir)
    return metrics.error_metrics(pred, test).select("n_pred", "n_truth", r6("mse"), r6("rmse"), r6("rmse_all"))


@register("metric_map")
def q_metric_map(spark, sf_dir):
    """AG11 / JN11 / AG9: MAP of each user's held-out items ranked by the
    pseudo-prediction, relevant = held-out ratings of 4 and above."""
    pred, test = _pseudo_predictions(spark, sf_dir)
    relevant = test.filter(F.col("rating") >= 4.0)
    return metrics.mean_average_precision_scored(pred, relevant).select(r6("map"), "n_users")


# ---- dense vectors ----------------------------------------------------------------------------

@register("vector_cosine_pairs")
def q_vector_cosine_pairs(spark, sf_dir):
    """RC10 / JN2 / SC9 / PR7 / PR8: embedding pairs with cosine >= 0.3, both directions."""
    emb = table(spark, sf_dir, "embeddings")
    return vectors.vector_similarity(emb, "vec_id", "embedding", min_similarity=0.3).select(
        "id1", "id2", r6("similarity"))


@register("vector_top_similar")
def q_vector_top_similar(spark, sf_dir):
    """WN4: the 10 nearest embeddings of every embedding by cosine, itself excluded."""
    emb = table(spark, sf_dir, "embeddings")
    return vectors.vector_similarity(emb, "vec_id", "embedding", min_similarity=None, top_n=10).select(
        "id1", "id2", r6("similarity"), "rank")


# ---- segments and counters --------------------------------------------------------------------

@register("like_minded_users")
def q_like_minded_users(spark, sf_dir):
    """RC13 / JN4 / PR9 / AG13: age-18, occupation-2 users who rated an ECONOMY item 5."""
    return segments.like_minded_users(fixtures.ratings(spark, sf_dir), fixtures.catalog_basic(spark, sf_dir),
                                      fixtures.users(spark, sf_dir), "ECONOMY", limit=10)


@register("known_users")
def q_known_users(spark, sf_dir):
    """JN10: event users with a rating history."""
    return segments.split_users(fixtures.rating_events(spark, sf_dir), fixtures.ratings(spark, sf_dir))[0]


@register("new_users")
def q_new_users(spark, sf_dir):
    """JN10: event users without a rating history."""
    return segments.split_users(fixtures.rating_events(spark, sf_dir), fixtures.ratings(spark, sf_dir))[1]


@register("popular_items")
def q_popular_items(spark, sf_dir):
    """RC19: the five most rated items."""
    return segments.popular_items(fixtures.ratings(spark, sf_dir), 5)


@register("new_user_defaults")
def q_new_user_defaults(spark, sf_dir):
    """RC19 / STR8 routing: new users get the popular list."""
    ev, hist = fixtures.rating_events(spark, sf_dir), _ratings_once(spark, sf_dir)
    new = segments.split_users(ev, hist)[1]
    return segments.default_for_new_users(new, segments.popular_items(hist, 5))


@register("order_totals")
def q_order_totals(spark, sf_dir):
    """AG10 / SC13 / STR5: per product count and price total from JSON order messages."""
    return segments.order_totals(segments.parse_orders(fixtures.order_payloads(spark, sf_dir)))


@register("order_grand_total")
def q_order_grand_total(spark, sf_dir):
    """STR5 grand total over all order messages."""
    return segments.grand_total(segments.parse_orders(fixtures.order_payloads(spark, sf_dir)))


@register("minute_totals")
def q_minute_totals(spark, sf_dir):
    """STR6: per product and one-minute window, count and price total of the event stream."""
    return segments.minute_totals(segments.parse_orders(fixtures.event_payloads(spark, sf_dir)))


@register("word_count")
def q_word_count(spark, sf_dir):
    """AG12 / PR12: words of every whole document split on spaces, counted."""
    return segments.word_count(table(spark, sf_dir, "documents"))


@register("parsed_events")
def q_parsed_events(spark, sf_dir):
    """PR1 / SC15 / SC14: CSV rating messages parsed back to typed columns."""
    good, _ = text_fn.split_rejects(text_fn.parse_rating_csv(fixtures.rating_payloads(spark, sf_dir)))
    return good.select("event_id", "user_id", "item_id", "rate", "epoch_ms")


# ---- ALS (rows-only: factor models have no SQL oracle) ----------------------------------------

ALS_PARAMS = {"rank": 8, "max_iter": 5, "reg": 0.1}


def _als_train(spark, sf_dir):
    sp = ratings_ops.split_ratings(_ratings_once(spark, sf_dir))
    return sp, factors.train_als(sp["train"], **ALS_PARAMS)


@register("als_predict_pairs")
def q_als_predict_pairs(spark, sf_dir):
    """RC1 / RC5: ALS trained on the training split predicts the test split."""
    sp, model = _als_train(spark, sf_dir)
    return factors.predict(model, sp["test"]).select("user_id", "item_id", r6("prediction"))


@register("als_recommend_all")
def q_als_recommend_all(spark, sf_dir):
    """RC8 / RC11: top 10 items for every user."""
    _, model = _als_train(spark, sf_dir)
    return factors.recommend_all(model, 10).select("user_id", "item_id", r6("prediction"), "rank")


@register("als_recommend_subset")
def q_als_recommend_subset(spark, sf_dir):
    """RC7: top 10 for the users that sent rating events (seen items not excluded)."""
    _, model = _als_train(spark, sf_dir)
    users = fixtures.rating_events(spark, sf_dir).select("user_id")
    return factors.recommend_for(model, users, 10).select("user_id", "item_id", r6("prediction"), "rank")


@register("als_unseen_top10")
def q_als_unseen_top10(spark, sf_dir):
    """RC9 / ST1 / JN9: personal ratings join training, then the 10 best unseen items."""
    sp = ratings_ops.split_ratings(_ratings_once(spark, sf_dir))
    mine = ratings_ops.assert_not_empty(ratings_ops.positive_personal(fixtures.my_ratings(spark, sf_dir)),
                                        "personal ratings")
    model = factors.train_als(ratings_ops.with_personal(sp["train"], mine), **ALS_PARAMS)
    items = fixtures.catalog_basic(spark, sf_dir).select("id")
    return factors.recommend_unseen(model, fixtures.PERSONAL_USER_ID, items, mine, 10).select(
        "user_id", "item_id", r6("prediction"), "rank")


def _grid(spark, sf_dir, grid, implicit=False):
    """RC3 / AG4 / AG6: every grid point's validation RMSE; on the row of the best model also its test RMSE, the RMSE of the
    mean baseline and the improvement over it.  Only these metric scalars pass through the driver."""
    sp = ratings_ops.split_ratings(_ratings_once(spark, sf_dir))
    results, best = factors.grid_search(sp["train"], sp["validation"], grid, implicit=implicit)
    base = metrics.baseline_rmse(sp["train"].unionByName(sp["validation"]), sp["test"]).first()["baseline_rmse"]
    test = metrics.error_metrics(factors.predict(best, sp["test"]), sp["test"]).first()["rmse"] if best else None
    top = min((r["rmse"] for r in results if r["rmse"] == r["rmse"]), default=None)
    rows, found = [], False
    for r in results:
        is_best = not found and r["rmse"] == top
        found |= is_best
        better = (base - test) / base * 100.0 if is_best and base and test is not None else None
        rows.append((r["rank"], float(r["reg"]), r["max_iter"], float(r.get("alpha", 1.0)), float(r["rmse"]), int(r["n_pred"]), is_best,
                     test if is_best else None, base if is_best else None, better))
    return spark.createDataFrame(rows, "rank int, reg double, max_iter int, alpha double, rmse double, n_pred bigint, is_best boolean, "
                                       "test_rmse double, baseline_rmse double, improvement_pct double")


@register("als_grid")
def q_als_grid(spark, sf_dir):
    """RC3 / AG4 / AG6: the 2 x 2 x 2 grid on the validation split, the best model on the test split."""
    return _grid(spark, sf_dir, factors.GRID_SELECTION)


@register("als_grid_alt")
def q_als_grid_alt(spark, sf_dir):
    """RC3: the second grid (longer training)."""
    return _grid(spark, sf_dir, factors.GRID_SELECTION_ALT)


@register("als_grid_implicit")
def q_als_grid_implicit(spark, sf_dir):
    """RC2 / RC3: the grid of the implicit variant, with its confidence weight."""
    return _grid(spark, sf_dir, factors.GRID_IMPLICIT, implicit=True)


@register("als_implicit")
def q_als_implicit(spark, sf_dir):
    """RC2: implicit-preference ALS (alpha 1.0), top 10 per user."""
    sp = ratings_ops.split_ratings(_ratings_once(spark, sf_dir))
    model = factors.train_als(sp["train"], rank=10, max_iter=10, reg=1.0, implicit=True, alpha=1.0)
    return factors.recommend_all(model, 10).select("user_id", "item_id", r6("prediction"), "rank")


@register("als_factor_similarity")
def q_als_factor_similarity(spark, sf_dir):
    """RC10 / P2: item-item cosine over ALS item factors, >= 0.6, both directions."""
    _, model = _als_train(spark, sf_dir)
    return factors.factor_similarity(model, 0.6).select("id1", "id2", r6("similarity"))


@register("als_similar_items")
def q_als_similar_items(spark, sf_dir):
    """WN4: the 10 items whose factors are closest to one item's (itself excluded)."""
    _, model = _als_train(spark, sf_dir)
    item = fixtures.ratings(spark, sf_dir).groupBy("item_id").count() \
        .orderBy(F.col("count").desc(), "item_id").first()["item_id"]
    return factors.similar_items(model, int(item), 10).select("id1", "id2", r6("similarity"), "rank")


@register("als_metrics")
def q_als_metrics(spark, sf_dir):
    """AG7 / AG11 / RC11: test-split MSE / RMSE, and MAP of every user's ranking of the whole
    catalog against held-out ratings of 4 and above."""
    sp, model = _als_train(spark, sf_dir)
    err = metrics.error_metrics(factors.predict(model, sp["test"]), sp["test"])
    relevant = sp["test"].filter(F.col("rating") >= 4.0)
    users = model.userFactors.select(F.col("id").alias("user_id"))
    mp = metrics.mean_average_precision_of_hits(factors.full_ranks(model, relevant), users, relevant)
    return err.select("n_pred", "n_truth", r6("mse"), r6("rmse"), r6("rmse_all"),
                      F.round(mp.select("map").scalar(), 6).alias("map"))


# ---- what SQL can say about models --------------------------------------------------------------

def _list_facts(recs, value="prediction", key="user_id", other="item_id"):
    """Per list: its length, and whether it is in order, without repeats, and of finite values."""
    w = Window.partitionBy(key).orderBy("rank")
    r = recs.withColumn("_before", F.lag(value).over(w))
    return r.groupBy(F.col(key).cast("bigint").alias(key)).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("_before").isNull() | (F.col("_before") >= F.col(value))).alias("in_order"),
        (F.count_distinct(other) == F.count(F.lit(1))).alias("no_repeats"),
        F.bool_and((F.abs(F.col(value)) < float("inf")) & ~F.isnan(value)).alias("finite"))


@register("als_predict_facts")
def q_als_predict_facts(spark, sf_dir):
    """RC1 / RC5 / RC6: how many test pairs get a prediction, and that training beats the mean on its own ratings."""
    sp, model = _als_train(spark, sf_dir)
    pred = factors.predict(model, sp["test"])
    fit = metrics.error_metrics(factors.predict(model, sp["train"]), sp["train"]).select("rmse").scalar()
    base = sp["train"].agg(F.stddev_pop("rating").alias("s")).select("s").scalar()
    return pred.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("n_users"), F.count_distinct("item_id").alias("n_items"),
                    F.bool_and(~F.isnan("prediction")).alias("finite")).withColumn("beats_mean", fit < base)


@register("als_recommend_all_facts")
def q_als_recommend_all_facts(spark, sf_dir):
    """RC8: every user's list."""
    return _list_facts(factors.recommend_all(_als_train(spark, sf_dir)[1], 10))


@register("als_recommend_subset_facts")
def q_als_recommend_subset_facts(spark, sf_dir):
    """RC7: the lists of the users with events."""
    users = fixtures.rating_events(spark, sf_dir).select("user_id")
    return _list_facts(factors.recommend_for(_als_train(spark, sf_dir)[1], users, 10))


@register("als_unseen_facts")
def q_als_unseen_facts(spark, sf_dir):
    """RC9: the personal list, none of it rated."""
    recs = stored(REGISTRY["als_unseen_top10"](spark, sf_dir), "unseen")
    mine = ratings_ops.positive_personal(fixtures.my_ratings(spark, sf_dir)).select("item_id")
    seen = recs.join(mine, "item_id", "left_semi").agg(F.count(F.lit(1)).alias("c")).select("c").scalar()
    return _list_facts(recs).withColumn("n_seen", seen)


@register("als_implicit_facts")
def q_als_implicit_facts(spark, sf_dir):
    """RC2: every user's list of the implicit model."""
    return _list_facts(REGISTRY["als_implicit"](spark, sf_dir))


@register("als_factor_similarity_facts")
def q_als_factor_similarity_facts(spark, sf_dir):
    """RC10: both directions of each pair, none of an item with itself, none below the threshold, known items only."""
    train = ratings_ops.split_ratings(fixtures.ratings(spark, sf_dir))["train"].select(F.col("item_id").alias("id1")).distinct()
    return factors.pair_facts(REGISTRY["als_factor_similarity"](spark, sf_dir), train, 0.6)


@register("als_similar_items_facts")
def q_als_similar_items_facts(spark, sf_dir):
    """WN4: the list of the item with the most ratings."""
    return _list_facts(REGISTRY["als_similar_items"](spark, sf_dir), "similarity", "id1", "id2")


@register("als_grid_facts")
def q_als_grid_facts(spark, sf_dir):
    """RC3: the grid's points, how many validation pairs each predicts, and that one best model has its metrics."""
    g = REGISTRY["als_grid"](spark, sf_dir)
    return g.groupBy("rank", "reg", "max_iter").agg(F.max("n_pred").alias("n_pred"), F.bool_and(~F.isnan("rmse")).alias("finite")).withColumn(
        "n_best", g.agg(F.count_if(F.col("is_best") & F.col("improvement_pct").isNotNull()).alias("c")).select("c").scalar())


@register("als_metrics_facts")
def q_als_metrics_facts(spark, sf_dir):
    """AG7 / AG11: counts, and bounds that hold for any model."""
    m = REGISTRY["als_metrics"](spark, sf_dir)
    return m.select("n_pred", "n_truth", (F.abs(F.sqrt("mse") - F.col("rmse")) < 1e-4).alias("rmse_is_root"),
                    (F.col("rmse_all") <= F.col("rmse")).alias("all_pairs_below"), F.col("map").between(0, 1).alias("map_in_range"))


# ---- sink formats and smaller operators --------------------------------------------------------

@register("rating_messages")
def q_rating_messages(spark, sf_dir):
    """SNK6 / SC14: every rating as a keyed ``user|item|rating`` message."""
    from .sinks.writers import rating_messages
    return rating_messages(fixtures.ratings(spark, sf_dir))


@register("similarity_lines")
def q_similarity_lines(spark, sf_dir):
    """SNK1 / SC14: factor-style similar-items table as ``id1,id2,sim`` text lines
    (content similarity >= 0.6, similarity rounded to 6 places)."""
    sim = content.content_similarity(fixtures.catalog(spark, sf_dir), min_similarity=SIMILAR_TABLE_THRESHOLD)
    return sim.select(text_fn.csv_line("id1", "id2", F.format_string("%.6f", F.col("similarity"))).alias("value"))


@register("top_rated_by_user")
def q_top_rated_by_user(spark, sf_dir):
    """TK2: each user's ten highest ratings (ties to the smaller item)."""
    return segments.first_ratings_per_user(fixtures.ratings(spark, sf_dir), 10).select(
        "user_id", "item_id", "rating", "rank")


@register("popular_titles")
def q_popular_titles(spark, sf_dir):
    """RC19 / JN5: the popular list with item titles from the catalog."""
    pop = segments.popular_items(fixtures.ratings(spark, sf_dir), 5)
    return segments.attach_titles(pop, fixtures.catalog_basic(spark, sf_dir))


@register("rating_split_counts_leaking")
def q_rating_split_counts_leaking(spark, sf_dir):
    """Q6 option: the split whose training part (bucket < 8) includes validation."""
    return ratings_ops.split_counts(fixtures.ratings(spark, sf_dir), ratings_ops.SPLITS_LEAKING)


@register("genre_pools")
def q_genre_pools(spark, sf_dir):
    """WN5 / PR10 / SC12: the 50 best-scored items of every first-genre token."""
    cat = fixtures.catalog_basic(spark, sf_dir)
    genres = cat.select(text_fn.first_token(F.col("filmtype")).alias("genre")).distinct()
    return neighbors.genre_pools(genres, cat).select("genre", "id", "score", "pool_rank")


@register("latest_events")
def q_latest_events(spark, sf_dir):
    """Q22: the newest rating event of each user (what one batch recomputes)."""
    return neighbors.latest_event_per_user(fixtures.rating_events(spark, sf_dir))


@register("running_totals")
def q_running_totals(spark, sf_dir):
    """STR4 / SNK7: cumulative per-product count and price after each day of orders."""
    return segments.running_totals_by_day(segments.parse_orders(fixtures.order_payloads(spark, sf_dir)))
