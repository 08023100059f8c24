"""Structured Streaming pipelines: STR1-STR8 with sinks SNK3, SNK4, SNK7, SNK8.

* The recommender runs P5 inside ``foreachBatch``: every micro-batch is
  handled as one set of joins (latest event per user, history, similarity,
  aggregate), never per record.  Ranking windows are not allowed on
  streaming DataFrames, which is why the scoring sits in ``foreachBatch``.
* What a stream updates by key (users' lists and ratings, totals) is an upsert table (``sinks.upsert``): a batch
  rewrites only the buckets it touches, a replayed one changes nothing, and neither reads nor folders grow with the
  stream's age.  A stream that starts again from an empty checkpoint needs an empty table.
* Variant A's latest ratings are keyed state (``streaming.recent``).
* Appended output is written to ``batch_id=<n>`` partitions with dynamic partition overwrite, so a batch replayed after
  a failure replaces its own output instead of appending twice.
* Intermediate tables of a batch are removed when its output is written.
* Offsets and state live in ``checkpointLocation`` under the session's shared
  checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import parse_rating_csv, split_rejects
from ..operators import neighbors, segments
from ..operators.ratings import latest_rating
from ..plans.materialize import dropped_after, stored
from ..session import scratch_path
from ..sinks.upsert import UpsertTable
from .recent import with_recent

DEFAULT_TRIGGER = {"processingTime": "10 seconds"}   # STR1


def pin_static(df: DataFrame, keys: list[str], n: int | None = None) -> DataFrame:
    """Hash-partition a static join side once and cache it for the life of the
    stream.  Every micro-batch join on ``keys`` then shuffles only the batch's
    rows; the big static side keeps its partitioning (the cache is rebuilt
    from its short lineage if an executor is lost)."""
    from pyspark import StorageLevel

    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).persist(StorageLevel.MEMORY_AND_DISK)


def _writer(df: DataFrame, trigger: dict | None, checkpoint: str):
    w = df.writeStream.option("checkpointLocation", checkpoint)
    t = trigger or DEFAULT_TRIGGER
    return w.trigger(**t)


def write_batch_partition(df: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent per-batch write: overwrite only this batch's partition."""
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


#: Buckets of the upsert tables of a stream.
BUCKETS = 64


def list_table(spark: SparkSession, out_path: str, buckets: int = BUCKETS) -> UpsertTable:
    """SNK4: users' packed lists, one row each."""
    return UpsertTable(spark, f"{out_path}/lists", ["user_id"], buckets=buckets)


def rating_table(spark: SparkSession, out_path: str, buckets: int = BUCKETS) -> UpsertTable:
    """The stream's own ratings, one row for each user and item, a user's in one bucket."""
    return UpsertTable(spark, f"{out_path}/ratings", ["user_id", "item_id"], by=["user_id"], buckets=buckets)


def total_table(spark: SparkSession, out_path: str, buckets: int = BUCKETS) -> UpsertTable:
    """SNK7: totals of each product."""
    return UpsertTable(spark, out_path, ["id"], buckets=buckets)


def current_lists(spark: SparkSession, out_path: str, before: int | None = None, only: list[int] | None = None) -> DataFrame | None:
    """Each user's newest packed list; with ``before``, as that batch found it."""
    return list_table(spark, out_path).read(before, only)


def live_history(history: DataFrame | Callable[[], DataFrame], users: DataFrame, ratings: UpsertTable, before: int) -> DataFrame:
    """Ratings of the batch's users as of the batch: the static ``history`` (or what a function reads anew) and the
    ratings that batches earlier than ``before`` brought, the newest per user and item.  Both are reduced to the
    batch's users before anything is ranked, the table to their buckets before it is read."""
    base = history() if callable(history) else history
    rows = base.select("user_id", "item_id", "rating", "ts").join(users, "user_id", "left_semi")
    log = ratings.read(before, ratings.buckets_of(users))
    if log is None:
        return rows
    told = log.join(users, "user_id", "left_semi").select(
        "user_id", "item_id", "rating", F.col("ts").cast(rows.schema["ts"].dataType).alias("ts"))
    return newest_ratings(rows.unionByName(told))


def newest_ratings(rows: DataFrame) -> DataFrame:
    """The newest rating of each user and item."""
    return rows.groupBy("user_id", "item_id").agg(F.max(F.struct("ts", "rating")).alias("m")).select(
        "user_id", "item_id", "m.rating", "m.ts")


def keep_ratings(batch: DataFrame, ratings: UpsertTable, batch_id: int) -> None:
    """Keep the ratings of a batch for later batches, the newest of each user and item."""
    new = newest_ratings(batch.select("user_id", "item_id", F.col("rate").alias("rating"), F.col("event_ts").alias("ts")))
    old = ratings.read(batch_id, ratings.buckets_of(new))
    if old is not None:
        # a late rating does not replace a newer one
        new = newest_ratings(new.unionByName(old.join(new.select("user_id", "item_id"), ["user_id", "item_id"], "left_semi")))
    ratings.upsert(stored(new, "batch-ratings", compact=True), batch_id)


def parsed_rating_stream(messages: DataFrame) -> DataFrame:
    """PR1 on a stream: typed columns plus ``_valid``; jobs split good rows from
    rejects per batch (``split_batch``), so a malformed message never fails a task."""
    return parse_rating_csv(messages).select(
        "value", "user_id", "item_id", "rate", "epoch_ms",
        F.timestamp_millis(F.col("epoch_ms")).alias("event_ts"), "_valid")


def split_batch(batch: DataFrame, batch_id: int, rejects_path: str | None) -> DataFrame:
    """Good rows of a parsed batch; rejected raw messages go to ``rejects_path``
    (idempotent per batch) when one is given."""
    good, bad = split_rejects(batch)
    if rejects_path is not None:
        write_batch_partition(bad.select("value"), rejects_path, batch_id)
    return good.drop("value")


def recommender_batch(batch: DataFrame, history: DataFrame, similarity: DataFrame, top_similar: DataFrame,
                      catalog: DataFrame, last: DataFrame | None, params: dict | None = None,
                      unordered_similarity: bool = False) -> DataFrame:
    """P5 variant B for one batch: users of the batch (latest event each, Q22),
    scores (RC15/RC16), merge with their last list (RC17), supplement (RC18)."""
    params = params or neighbors.VARIANT_B1
    users = batch.select("user_id", "item_id", F.col("event_ts").alias("ts"), F.lit(0).alias("event_id"))
    users = neighbors.latest_event_per_user(users).select("user_id")
    now = neighbors.neighbor_score_b(users, history, top_similar, similarity, catalog, n=params["n"],
                                     min_similarity=params["min_similarity"], score_cut=params["score_cut"],
                                     score_source=params["score_source"],
                                     unordered_similarity=unordered_similarity)
    if last is not None:
        merged = neighbors.merge_decayed(now, last, params["n"])
    else:
        merged = neighbors.merge_decayed(now, now.limit(0), params["n"])
    anchors = latest_rating(history.join(users, "user_id", "left_semi"))
    return neighbors.supplement(merged, anchors, catalog, history)


def start_recommender(spark: SparkSession, messages: DataFrame, history: DataFrame | Callable[[], DataFrame], similarity: DataFrame,
                      top_similar: DataFrame, catalog: DataFrame, out_path: str,
                      checkpoint: str | None = None, trigger: dict | None = None,
                      params: dict | None = None, rejects_path: str | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """STR2 + SNK4: per batch, recompute and upsert each active user's packed list.

    Lists are the upsert table ``out_path/lists``; the last list of a user (RC17 input) is read from it, so a
    user's lists chain from batch to batch (Q18, Q21 upsert).  The rating history is the one given plus the ratings of
    earlier batches (table ``out_path/ratings``); a function is called anew for every batch.  A batch reads only the
    buckets of its users, and a replayed one sees what was there before it, so it finds the same again.
    """
    events = parsed_rating_stream(messages)
    checkpoint = checkpoint or scratch_path(spark, "recommender-ckpt")
    # the similarity table is symmetric: keep each pair once (id1 < id2) and look
    # it up on normalised keys, which halves the cached static side
    similarity = pin_static(similarity.filter(F.col("id1") < F.col("id2")), ["id1", "id2"])
    top_similar = pin_static(top_similar, ["id1"])
    catalog = pin_static(catalog, ["id"])
    if isinstance(history, DataFrame):
        history = pin_static(history, ["user_id"])
    lists, ratings = list_table(spark, out_path, buckets), rating_table(spark, out_path, buckets)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = split_batch(batch, batch_id, rejects_path)
        if batch.isEmpty():                                   # TK6
            return
        with dropped_after(spark):
            users = batch.select("user_id").distinct()
            seen = live_history(history, users, ratings, batch_id)
            prev = lists.read(batch_id, lists.buckets_of(users))
            last = None
            if prev is not None:
                last = prev.join(users, "user_id", "left_semi") \
                    .select("user_id", F.explode("entries").alias("e")).select(
                        "user_id", F.col("e.item_id").alias("item_id"), F.col("e.priority").alias("priority"))
            recs = recommender_batch(batch, seen, similarity, top_similar, catalog, last, params,
                                     unordered_similarity=True)
            packed = neighbors.pack_recommendations(recs)
            entries = recs.groupBy("user_id").agg(F.array_sort(F.collect_list(
                F.struct("slot", "item_id", "priority"))).alias("entries"))
            now = packed.join(entries, "user_id").withColumn("batch_id", F.lit(batch_id))
            lists.upsert(stored(now, "batch-lists", compact=True), batch_id)
            keep_ratings(batch, ratings, batch_id)

    return _writer(events, trigger, checkpoint).foreachBatch(handle).start()


def numbered_events(batch: DataFrame) -> DataFrame:
    """event_id, user_id, item_id, ts of every message; equal messages are counted and numbered, so that none is dropped
    and their names do not depend on the order of rows."""
    message = ["user_id", "item_id", "rate", "epoch_ms"]
    counted = batch.groupBy(*message, "event_ts").agg(F.count(F.lit(1)).alias("n"))
    each = counted.withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    name = F.when(F.col("i") == 1, F.xxhash64(*message)).otherwise(F.xxhash64(*message, "i"))
    return each.select(name.alias("event_id"), "user_id", "item_id", F.col("event_ts").alias("ts"))


def start_variant_a(spark: SparkSession, messages: DataFrame, history: DataFrame, similar: DataFrame,
                    out_path: str, checkpoint: str | None = None, trigger: dict | None = None,
                    rejects_path: str | None = None, pair_scores: neighbors.PairScores | None = None) -> StreamingQuery:
    """STR2 + SNK3: variant A scores appended per batch, with user id and event time (Q15).

    Every user's latest ratings are keyed state that starts from ``history`` (``streaming.recent``).
    Candidates come from ``similar``, partitioned by the event's item; pair similarities come from ``pair_scores``
    (``neighbors.PairScores``; ``similar`` itself when not given).  Every message is
    scored.  Events are named by a hash of their message and, from the second of equal messages of a batch on, its
    number among them; so names hold on replay, and the batch tells apart equal messages of different batches."""
    parsed = parsed_rating_stream(messages)
    checkpoint = checkpoint or scratch_path(spark, "variant-a-ckpt")
    pair_scores = similar if pair_scores is None else pair_scores
    if isinstance(pair_scores, DataFrame):
        pair_scores = pin_static(pair_scores, ["id1", "id2"])
    similar = pin_static(similar, ["id1"])
    params = dict(neighbors.VARIANT_A)
    events = with_recent(parsed, history, params["k"])

    def handle(batch: DataFrame, batch_id: int) -> None:
        with dropped_after(spark):
            batch = stored(batch, "variant-a-batch", compact=True)
            batch = split_batch(batch, batch_id, rejects_path)
            if batch.isEmpty():                               # TK6
                return
            told = batch.dropDuplicates(["user_id"]).select("user_id", F.explode(F.arrays_zip("recent_items", "recent_rates")).alias("r"))
            recent = told.select("user_id", F.col("r.recent_items").alias("recent_item"), F.col("r.recent_rates").alias("recent_rate"))
            scores = neighbors.neighbor_score_a(numbered_events(batch), None, similar, pair_scores, recent=recent, **params)
            write_batch_partition(scores, out_path, batch_id)

    return _writer(events, trigger, checkpoint).outputMode("append").foreachBatch(handle).start()


def start_batch_counter(spark: SparkSession, messages: DataFrame, out_path: str,
                        checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """STR3: number of records per micro-batch."""
    checkpoint = checkpoint or scratch_path(spark, "counter-ckpt")

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch_partition(batch.agg(F.count(F.lit(1)).alias("n_records")), out_path, batch_id)

    return _writer(messages, trigger, checkpoint).foreachBatch(handle).start()


def running_totals(messages: DataFrame) -> DataFrame:
    """STR4 / STR5 / SC13: cumulative count and price per product from state."""
    return segments.order_totals(segments.parse_orders(messages))


def start_running_totals(spark: SparkSession, messages: DataFrame, out_path: str, checkpoint: str | None = None,
                         trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """STR4 / STR5 + SNK7: per-product cumulative totals,
    in ``update`` mode through ``foreachBatch``: each batch upserts the
    keys it changed, with values read from state (never re-added to a store)."""
    checkpoint = checkpoint or scratch_path(spark, "totals-ckpt")
    totals = running_totals(messages)
    table = total_table(spark, out_path, buckets)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with dropped_after(spark):
            table.upsert(stored(batch, "batch-totals", compact=True), batch_id)

    return (totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DEFAULT_TRIGGER)).foreachBatch(handle).start())


def current_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """Per-product totals as of the newest batch that touched each product."""
    return total_table(spark, out_path).read()


def start_minute_totals(spark: SparkSession, messages: DataFrame, out_path: str, checkpoint: str | None = None,
                        trigger: dict | None = None, watermark: str = "10 minutes") -> StreamingQuery:
    """STR6: per product and one-minute event-time window, in ``append`` mode; the
    watermark bounds the state kept for late events."""
    checkpoint = checkpoint or scratch_path(spark, "minute-ckpt")
    orders = segments.parse_orders(messages).withWatermark("ts", watermark)
    agg = segments.minute_totals(orders)
    return (agg.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DEFAULT_TRIGGER)).format("parquet").option("path", out_path).start())


def start_console(df: DataFrame, trigger: dict | None = None) -> StreamingQuery:
    """SNK8: print each batch (debugging only)."""
    return df.writeStream.format("console").trigger(**(trigger or DEFAULT_TRIGGER)).start()


def run_available(q_factory: Callable[[], StreamingQuery]) -> None:
    """Run a query over what is available now and wait for it (tests, backfills)."""
    q = q_factory()
    q.awaitTermination()


def route_batch(batch: DataFrame, history: DataFrame, model, popular: DataFrame, k: int = 5, items: DataFrame | None = None) -> DataFrame:
    """STR8 for one batch: known users (JN10 semi join) get their ALS top ``k``
    (RC7), new users (anti join) the popular list (RC19).  ``items``: the model's item factors where they are stored already."""
    from ..operators import factors

    known, new = segments.split_users(batch, history)
    rec_known = factors.recommend_for(model, known, k, items=items).select(
        "user_id", "item_id", F.col("prediction").alias("score"), F.lit("model").alias("source"))
    rec_new = segments.default_for_new_users(new, popular).select(
        "user_id", "item_id", F.col("n_ratings").cast("double").alias("score"), F.lit("popular").alias("source"))
    return rec_known.unionByName(rec_new)


def start_user_router(spark: SparkSession, messages: DataFrame, history: DataFrame, model, popular: DataFrame,
                      out_path: str, checkpoint: str | None = None, trigger: dict | None = None,
                      k: int = 5, rejects_path: str | None = None) -> StreamingQuery:
    """STR8: route every batch's users to model or popular recommendations.  The item factors are stored once."""
    from ..operators import factors

    events = parsed_rating_stream(messages)
    checkpoint = checkpoint or scratch_path(spark, "router-ckpt")
    items = factors.stored_items(model)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = split_batch(batch, batch_id, rejects_path)
        users = batch.select(F.col("user_id").cast("bigint").alias("user_id")).distinct()
        with dropped_after(spark):
            write_batch_partition(route_batch(users, history, model, popular, k, items), out_path, batch_id)

    return _writer(events, trigger, checkpoint).foreachBatch(handle).start()


def start_grand_total(spark: SparkSession, messages: DataFrame, out_path: str, checkpoint: str | None = None,
                      trigger: dict | None = None) -> StreamingQuery:
    """STR5 grand total: one global streaming aggregate in ``complete`` mode (one
    row of state), written per batch."""
    checkpoint = checkpoint or scratch_path(spark, "grand-ckpt")
    total = segments.grand_total(segments.parse_orders(messages))

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch_partition(batch, out_path, batch_id)

    return (total.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DEFAULT_TRIGGER)).foreachBatch(handle).start())


def start_batch_totals(spark: SparkSession, messages: DataFrame, out_path: str, checkpoint: str | None = None,
                       trigger: dict | None = None) -> StreamingQuery:
    """STR5 / STR6 as written: per product count and price of each micro-batch
    alone (the "latest batch" value), stateless."""
    checkpoint = checkpoint or scratch_path(spark, "batch-totals-ckpt")
    orders = segments.parse_orders(messages)

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch_partition(segments.order_totals(batch), out_path, batch_id)

    return _writer(orders, trigger, checkpoint).foreachBatch(handle).start()
