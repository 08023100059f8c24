"""JN3, JN8, JN11, SRC11: tables bucketed and sorted by a key, read through the catalog, so that joins and aggregates on the
key plan without an exchange of that side.

The table lies in the shared folder (an external table with a name of its own); the metadata tell Spark how
its rows are dealt.  Rows are shuffled by the key once, when the table is written, and every reader reuses that.  There
are as many buckets as shuffle partitions, so that only the other side of a join is shuffled, to match.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import scratch_path
from .materialize import at_end, drop_tables


def bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """``df`` written in buckets of ``key`` (one file each, sorted by it) and read back as a catalog table, which goes
    when an enclosing ``dropped_after`` ends."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    title = f"{name}_{uuid.uuid4().hex}"
    path = scratch_path(spark, title)
    # rows that Spark deals by the key to n tasks are those of the n buckets: one file for each
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).format("parquet").saveAsTable(title)

    def drop() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {title}")
        drop_tables(spark, [path])

    at_end(drop)
    return spark.table(title)
