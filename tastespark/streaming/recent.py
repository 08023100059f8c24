"""WN1, STR2: each user's latest K ratings as keyed state of the stream.

``transformWithState`` keeps a list of at most K ratings for every user in the RocksDB state store, so a batch touches the
state of its own users and costs the same however long the stream has run; no log of past ratings is read.  The state starts
from a static rating history and is checkpointed with the stream's offsets, so a batch that runs again sees the state that
it saw the first time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ratings import recent_ratings

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "item_id bigint, rating double, ts_us bigint"
EVENTS = "user_id bigint, item_id bigint, rate double, epoch_ms bigint, event_ts timestamp, value string, good boolean"
#: Groups over which rejected messages are dealt; they have no state.
REJECTS = 1024
RECENT = "recent_items array<bigint>, recent_rates array<double>"


def newest(ratings: list[tuple[int, float, int]], k: int) -> list[tuple[int, float, int]]:
    """The latest ``k`` of (item, rating, time): one for each item (later time, then higher rating), newest first, ties to
    the smaller item."""
    best: dict[int, tuple[int, float]] = {}
    for item, rating, ts in ratings:
        if item not in best or (ts, rating) > best[item]:
            best[item] = ts, rating
    return sorted(((i, r, t) for i, (t, r) in best.items()), key=lambda x: (-x[2], x[0]))[:k]


class RecentRatings(StatefulProcessor):
    """Gives every event the user's ratings from before its batch, then takes the batch's own ratings in.  An item's later
    rating replaces its earlier one and times only rise, so the K newest are all that later batches can need."""

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", STATE)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        told = zip(initialState["item_id"], initialState["rating"], initialState["ts_us"])
        self._keep([(int(i), float(r), int(t)) for i, r, t in told])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[1]:                         # rejected messages pass
            for pdf in rows:
                yield pdf.drop(columns="part").assign(recent_items=[[]] * len(pdf), recent_rates=[[]] * len(pdf))
            return
        before = [tuple(r) for r in self.recent.get()] if self.recent.exists() else []
        held = list(before)
        for pdf in rows:
            told = zip(pdf["item_id"], pdf["rate"], pdf["event_ts"].astype("datetime64[us, UTC]" if pdf["event_ts"].dt.tz else "datetime64[us]").astype("int64"))
            held = newest([*held, *((int(i), float(r), int(t)) for i, r, t in told)], self.k)
            yield pdf.drop(columns="part").assign(recent_items=[[i for i, _, _ in before]] * len(pdf),
                                                  recent_rates=[[r for _, r, _ in before]] * len(pdf))
        self._keep(held)

    def _keep(self, ratings: list[tuple[int, float, int]]) -> None:
        self.recent.put(newest(ratings, self.k))

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """List state needs the RocksDB store; a session that names another provider keeps its own choice."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(key) or ""):
        spark.conf.set(key, ROCKSDB)


def with_recent(events: DataFrame, history: DataFrame, k: int) -> DataFrame:
    """The messages of a stream (``parsed_rating_stream``), valid ones each with its user's latest ``k`` ratings from before its batch."""
    use_rocksdb(events.sparkSession)
    start = recent_ratings(history, k).select(
        F.col("user_id").cast("bigint").alias("user_id"), F.col("item_id").cast("bigint").alias("item_id"),
        F.col("rating").cast("double").alias("rating"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), F.lit(0).alias("part"))
    part = F.when(F.col("_valid"), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("value"), F.lit(REJECTS))).cast("int")
    user = F.when(F.col("_valid"), F.col("user_id").cast("bigint")).otherwise(F.lit(0))
    rows = events.select(user.alias("user_id"), F.col("item_id").cast("bigint").alias("item_id"), F.col("rate").cast("double").alias("rate"),
                         F.col("epoch_ms").cast("bigint").alias("epoch_ms"), "event_ts", "value",
                         F.col("_valid").alias("good"), part.alias("part"))
    return rows.groupBy("user_id", "part").transformWithStateInPandas(
        RecentRatings(k), f"{EVENTS}, {RECENT}", "append", "none", initialState=start.groupBy("user_id", "part")) \
        .withColumnRenamed("good", "_valid")
