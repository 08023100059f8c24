"""Intermediate results that are read more than once, written to the shared folder.

A Parquet table keeps column pruning, filters and statistics for its readers and is
computed once; ``DataFrame.checkpoint`` would compute its input twice (once to count,
once to save) and store whole serialized rows.  The folder survives executor loss.

A table lives as long as the folder, unless it is written inside ``dropped_after``:
whoever writes the final result inside that block (a pipeline stage, a stream's batch)
has its intermediate tables removed when the block ends.
"""

from __future__ import annotations

import gc
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

_OPEN = threading.local()


def _scopes() -> list[list[Callable[[], None]]]:
    if not hasattr(_OPEN, "scopes"):
        _OPEN.scopes = []
    return _OPEN.scopes


def at_end(action: Callable[[], None]) -> None:
    """Run ``action`` when the innermost open ``dropped_after`` of this thread ends (never without one)."""
    if _scopes():
        _scopes()[-1].append(action)


def stored(df: DataFrame, name: str, compact: bool = False, keep: bool = False) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back with the same schema.

    ``compact`` deals the rows out to one file for each core: for narrow results whose many
    shuffle partitions would otherwise become as many small files.  ``keep`` leaves the table
    when an enclosing ``dropped_after`` ends."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    schema = df.schema
    (df.repartition(spark.sparkContext.defaultParallelism) if compact else df).write.parquet(path)
    if not keep:
        at_end(lambda: drop_tables(spark, [path]))
    return spark.read.schema(schema).parquet(path)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders through the file system that they are in."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop_unused(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files and cached blocks that no DataFrame or model refers to any more.

    It does so once their references are collected, which a driver with free memory puts off for up to half an hour,
    while a loop of jobs goes on filling the executors' disks."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


@contextmanager
def dropped_after(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stored`` writes in this thread inside the block are removed at its end, also after a failure."""
    _scopes().append([])
    try:
        yield
    finally:
        for action in _scopes().pop():
            action()
