"""Delimited text sources (SRC1-SRC6) and table scans (SRC11, SRC13).

Every reader takes an explicit schema (no inference pass) and selects the
fields by position, so Catalyst prunes the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ratings import assert_not_empty, positive_personal


def _text_fields(spark: SparkSession, path: str, sep: str, n: int) -> DataFrame:
    schema = ", ".join(f"_c{i} string" for i in range(n))
    # no quoting: quotation marks in these files are part of a field, and quoting would swallow separators
    return spark.read.schema(schema).option("sep", sep).option("quote", "").option("mode", "PERMISSIVE").csv(path)


def split_malformed(rows: DataFrame, *required: str) -> tuple[DataFrame, DataFrame]:
    """(rows with every required field, the other ones): a field that is missing or does not parse is null."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return rows.filter(ok), rows.filter(~ok)


def read_ratings_colons(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: ``user::item::rating::ts``."""
    d = _text_fields(spark, path, "::", 4)
    return d.select(d._c0.try_cast("int").alias("user_id"), d._c1.try_cast("int").alias("item_id"),
                    d._c2.try_cast("double").alias("rating"), d._c3.try_cast("bigint").alias("ts"))


def read_ratings_item_first(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: comma text in item, user, rating order (extra fields ignored)."""
    d = _text_fields(spark, path, ",", 3)
    return d.select(d._c1.try_cast("int").alias("user_id"), d._c0.try_cast("int").alias("item_id"),
                    d._c2.try_cast("double").alias("rating"))


def read_ratings_tab(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: tab text, the first three fields."""
    d = _text_fields(spark, path, "\t", 3)
    return d.select(d._c0.try_cast("int").alias("user_id"), d._c1.try_cast("int").alias("item_id"),
                    d._c2.try_cast("double").alias("rating"))


def read_items(spark: SparkSession, path: str, sep: str = "::") -> DataFrame:
    """SRC4: ``id::title::genres``, or with ``sep='|'`` the layout ``id|title|date|...``,
    of which id and title are read (its third field is a date, so genres are null).
    ``split_malformed(rows, "item_id")`` sets lines without a proper id apart."""
    d = _text_fields(spark, path, sep, 3)
    genres = d._c2 if sep == "::" else F.lit(None).cast("string")
    return d.select(d._c0.try_cast("int").alias("item_id"), d._c1.alias("title"), genres.alias("genres"))


def read_personal(spark: SparkSession, path: str, require: bool = True) -> DataFrame:
    """SRC5: personal ``user::item::rating`` lines, ratings above 0 only; raises when
    nothing is left (checked with ``limit(1)``)."""
    d = _text_fields(spark, path, "::", 3)
    r = d.select(d._c0.try_cast("int").alias("user_id"), d._c1.try_cast("int").alias("item_id"),
                 d._c2.try_cast("double").alias("rating"))
    r = positive_personal(r)
    return assert_not_empty(r, "personal ratings") if require else r


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: ``id::gender::age::occupation::...``; gender is ignored."""
    d = _text_fields(spark, path, "::", 4)
    return d.select(d._c0.try_cast("int").alias("id"), d._c2.try_cast("int").alias("age"),
                    d._c3.try_cast("int").alias("occupation"))


def read_table(spark: SparkSession, name: str, distinct: bool = False) -> DataFrame:
    """SRC11: catalog table scan (``select *`` / ``select distinct``)."""
    t = spark.table(name)
    return t.distinct() if distinct else t


def from_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """SRC13: a small local collection as a DataFrame."""
    return spark.createDataFrame(rows, schema)


def with_bucket(ratings: DataFrame, ts_col: str = "ts", buckets: int = 10) -> DataFrame:
    """PR5 on integer time: ``bucket = ts % 10``."""
    return ratings.withColumn("bucket", F.pmod(F.col(ts_col), F.lit(buckets)))
