"""Dense 0..n-1 positions in a global order, computed without a single-task window.

The frame is range-partitioned by the order (``orderBy``), each row gets
``monotonically_increasing_id`` inside its partition, and per-partition row
counts (one row per partition) give the offsets.  The sorted frame is
written to the shared folder, so a recomputation after executor loss sees the same layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .materialize import stored


def dense_index(df: DataFrame, order: list[Column], name: str = "pos") -> DataFrame:
    cols = df.columns
    s = stored(df.orderBy(*order).select("*", F.spark_partition_id().alias("_pid"),
                                         F.monotonically_increasing_id().alias("_mid")), "index")
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a tiny single-partition window is fine here
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return s.join(F.broadcast(offs), "_pid").select(*cols, (F.col("_off") + local).alias(name))


def row_number_unbounded(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """``row_number()`` per key for groups of any size, without one task per group.

    The frame is range-partitioned by ``keys + order`` (a hot key spans several
    partitions), numbered inside each partition, and shifted by the count of
    the key's rows in earlier partitions.  The offset table has one row per
    (partition, key) and its window per key spans at most the partition count.
    ``order`` must end in a unique tie-breaker.
    """
    cols = df.columns
    s = stored(df.orderBy(*[F.col(k) for k in keys], *order).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")), "index")
    per = s.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select("_pid", *keys, "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    j = s.join(offs, ["_pid", *keys])
    return j.select(*cols, (F.col("_off") + F.col("_mid") - F.col("_first") + 1).alias(name))


def running_totals(df: DataFrame, keys: list[str], order: list[Column], sums: dict[str, str],
                   rank: str = "rank") -> DataFrame:
    """Row number and running sums per key for groups of any size, in one
    distributed sort (the same layout as ``row_number_unbounded``).

    ``sums`` maps an output column to the column it accumulates (inclusive of
    the current row).  Within a partition the running values come from a window
    over (partition, key) -- bounded by the partition size -- and are shifted
    by the key's totals in earlier partitions.
    """
    cols = df.columns
    s = stored(df.orderBy(*[F.col(k) for k in keys], *order).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")), "index")
    local = Window.partitionBy("_pid", *keys).orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    s = s.select("*", *[F.sum(src).over(local).alias(f"_loc_{out}") for out, src in sums.items()])
    per = s.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"),
                                       *[F.sum(src).alias(f"_tot_{out}") for out, src in sums.items()])
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select("_pid", *keys, "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
                      *[F.coalesce(F.sum(f"_tot_{out}").over(w), F.lit(0)).alias(f"_off_{out}") for out in sums])
    j = s.join(offs, ["_pid", *keys])
    return j.select(*cols, (F.col("_off") + F.col("_mid") - F.col("_first") + 1).alias(rank),
                    *[(F.col(f"_off_{out}") + F.col(f"_loc_{out}")).alias(out) for out in sums])
