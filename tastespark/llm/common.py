"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastespark.io import table
from tastespark.plans.materialize import stored  # noqa: F401  (used by the operators)
from tastespark.session import scratch_path, ship_package

# white space of the word definition: space and tab .. carriage return
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Ship the package to the executors and bound the rows of one Arrow batch,
    so that a batch of long texts fits in a worker's memory."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Plans made inside use Arrow batches of ``rows`` rows: fewer where single rows are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_HELD: dict[str, Callable[[], None]] = {}


def hold(name: str, drop: Callable[[], None]) -> None:
    """Name a table that this worker process keeps between tasks, and how to drop it."""
    _HELD[name] = drop


def make_room(name: str = "") -> None:
    """Drop what other operators keep in this process: workers are reused by later stages."""
    for other in [k for k in _HELD if k != name]:
        _HELD.pop(other)()


def give_back() -> None:
    """Return freed memory to the system: a reused worker's heap has gaps that earlier stages left."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A folder of this call's own below the shared checkpoint folder."""
    return scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def parallelism(spark: SparkSession) -> int:
    """Partitions for shuffles whose work per row is large."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def text_chunks(texts: list, limit: int = 1 << 22):
    """Cut a list of texts into runs of about ``limit`` characters: (start, stop)."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on an unsigned array (wraps modulo 2^64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def components(spark: SparkSession, edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge table (``a``, ``b`` long).

    Alternates large-star and small-star steps (map-reduce style contraction):
    every round is two grouped aggregates over the edges, no component is ever
    gathered in a task or on the driver, and hot nodes are pre-aggregated by
    ``min`` before the shuffle.  The edge table is rewritten each round, so a
    lost executor repeats one round at most.  Rounds grow with the logarithm of
    the component size.  Returns ``node``, ``component`` (the smallest node of
    the component), one row per node that occurs in an edge.
    """
    e = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
               f"{name}-edges", compact=True)
    if e.isEmpty():
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(max_rounds):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # a written side leaves the join free to split the edges of one node
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-low", compact=True)
        # large star: every larger neighbour of u goes to u's smallest neighbour
        big = e.select(F.col("a").alias("u"), F.col("b").alias("v")).join(low, "u").select(
            F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        small = big.groupBy("b").agg(F.min("a").alias("m"))
        nxt = big.join(small, "b").select(F.least("a", "m").alias("m0"), "a", "b", "m")
        nxt = nxt.select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).filter("a <> b").distinct()
        e = stored(nxt, f"{name}-round", compact=True)
        n = e.agg(F.count(F.lit(1)).alias("edges"), F.countDistinct("b").alias("children")).first()
        # stars only: every child has one parent and no parent is a child
        roots = e.select(F.col("a").alias("node")).distinct()
        if n["edges"] == n["children"] and roots.join(e.select(F.col("b").alias("node")), "node", "left_semi").isEmpty():
            return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component")))
    raise RuntimeError(f"{name}: components did not settle in {max_rounds} rounds")


def null_safe(left: str, right: str, *cols: str) -> Column:
    """Equi-join condition in which null equals null."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond
