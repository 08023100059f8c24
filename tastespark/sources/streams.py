"""Streaming sources (SRC9, SRC10, ST3).

``kafka`` reads one topic set with parallelism from its partitions (the
receivers-and-union pattern is unnecessary: one source already reads all
partitions in parallel).  ``files`` replays a directory of parquet event
files, which is how tests drive the pipelines; the payload is rebuilt as the
``user,item,rate,epoch_ms`` text a producer would send (SNK6 format), so the
same parser (PR1) runs for both sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures
from ..io import table


def kafka_stream(spark: SparkSession, servers: str, topics: str, **options) -> DataFrame:
    """Kafka source (needs the spark-sql-kafka package on the classpath)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("subscribe", topics)
    for k, v in options.items():
        reader = reader.option(k, v)
    try:
        df = reader.load()
    except Exception as e:  # noqa: BLE001
        if "kafka" in str(e).lower() and "data source" in str(e).lower():
            raise RuntimeError("the Kafka source needs the spark-sql-kafka package on the classpath "
                               "(--packages); use source='files' to replay files instead") from e
        raise
    return df.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("ts"))


def event_file_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """The ``events`` table as a file stream (the source needs a directory, so the
    file is selected by ``pathGlobFilter``)."""
    schema = table(spark, sf_dir, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(sf_dir))


def rating_message_stream(spark: SparkSession, sf_dir: str, source: str = "files", **kafka) -> DataFrame:
    """Rating messages ``user,item,rate,epoch_ms`` as a streaming ``value`` column."""
    if source == "kafka":
        return kafka_stream(spark, **kafka)
    ev = event_file_stream(spark, sf_dir)
    r = fixtures.events_to_ratings(ev, fixtures.part_count(spark, sf_dir))
    return r.select(F.concat_ws(",", F.col("user_id").cast("string"), F.col("item_id").cast("string"),
                                F.col("rate").cast("string"),
                                fixtures.epoch_millis(F.col("ts")).cast("string")).alias("value"),
                    F.col("ts").cast("timestamp").alias("ts"))


def order_message_stream(spark: SparkSession, sf_dir: str, source: str = "files", **kafka) -> DataFrame:
    """Order messages ``{"id": "...", "price": n}`` as a streaming ``value`` column;
    the file form replays ``lineitem``."""
    if source == "kafka":
        return kafka_stream(spark, **kafka)
    schema = table(spark, sf_dir, "lineitem").schema
    li = (spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet")
          .option("maxFilesPerTrigger", 1).parquet(sf_dir))
    return li.select(F.concat(F.lit('{"id": "'), F.col("l_partkey").cast("string"), F.lit('", "price": '),
                              F.floor(F.col("l_extendedprice")).cast("bigint").cast("string"), F.lit("}"))
                     .alias("value"), F.col("l_shipdate").cast("timestamp").alias("ts"))


def union_streams(*streams: DataFrame) -> DataFrame:
    """ST3: one stream from several sources of the same schema."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out
