"""Derived views of FIXTURES.md, built from the driver tables with DataFrame code.

ratings, catalog, users, my_ratings, rating_events, last_recs, order_events.
Every view is a lazy plan over the whole input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .io import table

# Fixed values of the fixture definitions (FIXTURES.md part B).
PERSONAL_USER_ID = 1000000
UNKNOWN_USER_OFFSET = 1000000
AGE_BY_NATION_MOD7 = [1, 18, 25, 35, 45, 50, 56]


def days_since_epoch(ts: Column) -> Column:
    return F.datediff(F.to_date(ts), F.lit("1970-01-01"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user, item); the latest order line wins.

    The per-key "latest" is a max over a struct (hash aggregate with map-side
    partial aggregation), not a window sort, so a user with a third of all
    lines still reduces on the map side before the shuffle.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = li.join(o, li.l_orderkey == o.o_orderkey)
    latest = joined.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).agg(
        F.max(F.struct("o_orderdate", "l_orderkey", "l_linenumber", "l_quantity",
                       "l_extendedprice")).alias("m"))
    return latest.select(
        "user_id", "item_id",
        F.ceil(F.col("m.l_quantity") / 10).cast("double").alias("rating"),
        F.col("m.o_orderdate").alias("ts"),
        F.pmod(days_since_epoch(F.col("m.o_orderdate")), F.lit(10)).cast("bigint").alias("bucket"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item catalog with '/'-separated multi-value attributes and '-1' gaps."""
    part = table(spark, sf_dir, "part")
    ps = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk")).distinct()
    order_key = F.pmod(F.col("sk") * 7919 + F.col("pk") * 31, F.lit(101))
    # Top 6 suppliers per part: Catalyst plans a partial WindowGroupLimit before the shuffle.
    rk = ps.withColumn("rn", F.row_number().over(Window.partitionBy("pk").orderBy(order_key, "sk"))) \
           .filter("rn <= 6")
    act = rk.groupBy("pk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "sk"))),
                                 lambda x: F.concat(F.lit("S"), x["sk"].cast("string"))), " / ").alias("actor"),
        F.min(F.when(F.col("rn") == 1, F.col("sk"))).alias("lead"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = supplier.join(F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey, "left") \
                  .join(F.broadcast(region), F.col("n_regionkey") == region.r_regionkey, "left")
    # supplier grows with the data: no hint, AQE turns it into a broadcast at run time
    # only when its measured shuffle size is under the threshold.
    act_geo = act.join(geo, act.lead == geo.s_suppkey, "left")
    j = part.join(act_geo, part.p_partkey == act_geo.pk, "left")
    pk = F.col("p_partkey")
    return j.select(
        pk.alias("id"),
        F.col("p_name").alias("name"),
        F.when(pk % 17 == 0, F.lit("-1")).otherwise(F.col("p_brand")).alias("director"),
        F.when(pk % 13 == 0, F.lit("-1")).otherwise(
            F.concat(F.lit("W"), (pk % 40).cast("string"), F.lit(" / W"), (pk % 7).cast("string"))).alias("writer"),
        F.coalesce(F.col("actor"), F.lit("-1")).alias("actor"),
        F.concat(F.col("p_type"), F.lit("/"), F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))).alias("filmtype"),
        F.when(F.col("p_size") == 50, F.lit(-1)).otherwise(F.lit(1970) + F.col("p_size")).cast("int").alias("releasedate"),
        F.coalesce(F.col("n_name"), F.lit("-1")).alias("area"),
        F.coalesce(F.col("r_name"), F.lit("-1")).alias("language"),
        F.round((F.col("p_retailprice") - 900) / 10, 2).alias("score"),
    )


def catalog_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog columns that depend on ``part`` alone (id, name, filmtype,
    releasedate, score): consumers that need no actor or region read one table
    instead of aggregating ``lineitem``."""
    pk = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        pk.alias("id"), F.col("p_name").alias("name"),
        F.concat(F.col("p_type"), F.lit("/"), F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))).alias("filmtype"),
        F.when(F.col("p_size") == 50, F.lit(-1)).otherwise(F.lit(1970) + F.col("p_size")).cast("int").alias("releasedate"),
        F.round((F.col("p_retailprice") - 900) / 10, 2).alias("score"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    m = F.col("c_nationkey") % 7
    age = F.element_at(F.array(*[F.lit(a) for a in AGE_BY_NATION_MOD7]), (m + 1).cast("int"))
    return c.select(F.col("c_custkey").alias("id"), age.cast("int").alias("age"),
                    (F.col("c_custkey") % 5).cast("int").alias("occupation"))


def my_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal ratings of a user unknown to ``ratings`` (zeros still present)."""
    p = table(spark, sf_dir, "part").filter(F.col("p_partkey") % 37 == 0)
    return p.select(F.lit(PERSONAL_USER_ID).cast("bigint").alias("user_id"),
                    F.col("p_partkey").alias("item_id"),
                    (F.col("p_partkey") % 6).cast("double").alias("rating"))


def part_count(spark: SparkSession, sf_dir: str) -> int:
    """Catalog size, a scalar used as a literal by the event mapping."""
    return table(spark, sf_dir, "part").count()


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating events derived from ``events``; every tenth comes from an unknown user."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    return events_to_ratings(ev, part_count(spark, sf_dir))


def events_to_ratings(ev: DataFrame, n_items: int) -> DataFrame:
    """Map raw events to (event_id, user_id, item_id, rate, ts); a pure projection,
    so it runs unchanged on a streaming DataFrame."""
    return ev.select(
        "event_id",
        (F.col("user_id") + F.when(F.col("event_id") % 10 == 0, F.lit(UNKNOWN_USER_OFFSET)).otherwise(F.lit(0)))
        .alias("user_id"),
        (F.col("event_id") % F.lit(n_items)).alias("item_id"),
        (F.lit(1) + F.floor(F.col("value")).cast("bigint") % 5).cast("double").alias("rate"),
        "ts",
    )


def last_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last recommendation list of every customer: ten (item, priority) each."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k")
    n_items = part_count(spark, sf_dir)
    ck = c.select("c_custkey", k)
    return ck.select(
        F.col("c_custkey").alias("user_id"),
        ((F.col("c_custkey") * 13 + F.col("k") * 17) % F.lit(n_items)).alias("item_id"),
        (F.lit(1) + ((F.col("c_custkey") * 7 + F.col("k") * 3) % 80).cast("double") / 10).alias("priority"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("id"),
                     F.floor(F.col("l_extendedprice")).cast("bigint").alias("price"),
                     F.col("l_shipdate").alias("ts"))


def order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events as JSON text messages ``{"id": "<id>", "price": <price>}``."""
    oe = order_events(spark, sf_dir)
    return oe.select(F.concat(F.lit('{"id": "'), F.col("id").cast("string"), F.lit('", "price": '),
                              F.col("price").cast("string"), F.lit("}")).alias("value"), "ts")


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as order messages: an item, a whole price and the event's time of day."""
    n_items = part_count(spark, sf_dir)
    ev = table(spark, sf_dir, "events").select("event_id", "value", "ts")
    return ev.select(F.concat(F.lit('{"id": "'), (F.col("event_id") % F.lit(n_items)).cast("string"), F.lit('", "price": '),
                              F.floor("value").cast("bigint").cast("string"), F.lit("}")).alias("value"), "ts")


def epoch_millis(ts: Column) -> Column:
    """Whole milliseconds since 1970-01-01 of a wall-clock (``timestamp_ntz``) time,
    independent of the session time zone."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def rating_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating events as CSV text messages ``user,item,rate,epoch_ms``."""
    re_ = rating_events(spark, sf_dir)
    return re_.select("event_id", F.concat_ws(
        ",", F.col("user_id").cast("string"), F.col("item_id").cast("string"), F.col("rate").cast("string"),
        epoch_millis(F.col("ts")).cast("string")).alias("value"), "ts")
