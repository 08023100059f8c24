"""Sinks: SNK1, SNK2, SNK5, SNK6, SNK8 (the streaming sinks SNK3, SNK4, SNK7 are in
``streaming.pipelines``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import csv_line


def write_similarity_lines(similarity: DataFrame, path: str) -> None:
    """SNK1: text lines ``id1,id2,sim``."""
    similarity.select(csv_line("id1", "id2", "similarity").alias("value")).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Default table sink (parquet)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 10_000,
               properties: dict | None = None) -> None:
    """SNK2: rows to a database table in batched multi-row inserts, one
    transaction per partition."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def rating_messages(ratings: DataFrame) -> DataFrame:
    """SNK6 format: ``user|item|rating`` keyed by user, so a keyed topic keeps each
    user's messages in order."""
    return ratings.select(F.col("user_id").cast("string").alias("key"),
                          csv_line("user_id", "item_id", "rating", sep="|").alias("value"))


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """SNK6: write ``key``/``value`` rows to a topic (needs the Kafka package)."""
    (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def show(df: DataFrame, n: int = 20) -> None:
    """SNK8: console print."""
    df.show(n, truncate=False)
