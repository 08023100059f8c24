"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 60-bit hash of its id and text.  A source with total size
``S`` and target ``T`` takes each of its documents ``floor(T / S)`` times, and
once more those whose hash lies below the source's threshold.  The threshold is
where the running total, in hash order, reaches the rest of the budget; it is
found without sorting documents: sizes are summed by (source, hash bucket), the
cumulative sums of the 4,096 buckets name the boundary bucket, and only the rows
of that bucket are binned again by the next 12 bits, five levels down to single
hashes.  Repeats are nested: the documents of a smaller budget are a subset of
those of a larger one with the same hash.

Everything is built from DataFrame operations.  Bucket sums are partially
aggregated before the shuffle, so a source with a third of all rows costs at
most 4,096 rows per task and level; documents themselves are never shuffled.

Defined results: null text has size 0; a null source is a source of its own
(last in order); a source of size 0 has target 0; rows with equal id and text
share a hash and are taken or left together; an empty table gives no rows;
columns of the input other than the named ones are ignored by ``mix`` and
kept by ``mixed_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastespark.llm.common import WORD, stored
from tastespark.plans.indexing import dense_index, running_totals

HASH_BITS = 60
LEVEL_BITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def unit_hash(doc_id: Column, text: Column, seed: str) -> Column:
    """The first 60 bits of an MD5 over seed, id and text."""
    key = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")),
                      F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """Targets per source: ``sizes`` has ``source``, ``source_size``.

    Sources in code point order (null last) weigh ``weights`` in turn and share
    the total size; no target exceeds ``cap`` times its source's size, and the
    excess is shared by weight among the others until none is above.  In the
    order of size/weight the capped sources are a prefix, so one running sum
    over the source table (a row per source, range-partitioned) finds them.
    """
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("_pos") % len(weights) + 1).cast("int"))
    ranked = dense_index(sizes, [F.asc_nulls_last("source")], "_pos").select(
        "source", "source_size", "_pos", w.cast("bigint").alias("_w"))
    # size / weight as an exact number: times the product of the weights
    unit = 1
    for x in set(weights):
        unit *= x
    per_weight = F.col("source_size").cast("decimal(30,0)") * (F.lit(unit) / F.col("_w")).cast("int")
    sums = running_totals(ranked.withColumn("_all", F.lit(0)), ["_all"], [per_weight, F.col("_pos")],
                          {"_cum_size": "source_size", "_cum_w": "_w"}, rank="_r")
    total, weight = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0], \
        ranked.agg(F.coalesce(F.sum("_w"), F.lit(0))).first()[0]
    big = "decimal(38,0)"
    capped = (cap * F.col("source_size")).cast(big) * (F.lit(weight) - F.col("_cum_w") + F.col("_w")).cast("decimal(12,0)") \
        < F.col("_w").cast("decimal(12,0)") * (F.lit(total) - cap * (F.col("_cum_size") - F.col("source_size"))).cast("decimal(25,0)")
    sums = sums.withColumn("_capped", capped)
    rest = sums.agg(F.sum(F.when(F.col("_capped"), F.col("source_size"))).alias("size"),
                    F.sum(F.when(~F.col("_capped"), F.col("_w"))).alias("w")).first()
    level = (total - cap * (rest["size"] or 0)) / rest["w"] if rest["w"] else 0.0
    target = F.when(F.col("_capped"), (cap * F.col("source_size")).cast("double")).otherwise(F.col("_w") * F.lit(float(level)))
    return sums.select("source", "source_size", F.least(target, (cap * F.col("source_size")).cast("double")).alias("target"))


def thresholds(units: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole ``repeats`` of every document and the hash ``threshold``
    below which a document is taken once more.  ``units``: source, size, h."""
    t = targets.select("source", "source_size", "target",
                       F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                       .otherwise(F.lit(0)).cast("bigint").alias("repeats"))
    t = t.withColumn("_rest", F.col("target") - F.col("repeats") * F.col("source_size"))
    # (source, prefix of the boundary bucket, size before it); at first the whole hash range
    edge = t.select("source", "_rest", F.lit(0).cast("bigint").alias("_prefix"), F.lit(0).cast("bigint").alias("_before"))
    bits = 0
    while bits < HASH_BITS:
        shift = HASH_BITS - bits
        bits += LEVEL_BITS
        child = F.shiftright("h", HASH_BITS - bits).alias("_child")
        rows = units.select(F.col("source").alias("_s"), F.shiftright("h", shift).alias("_p") if shift < HASH_BITS
                            else F.lit(0).cast("bigint").alias("_p"), "size", child)
        cells = rows.groupBy("_s", "_p", "_child").agg(F.sum("size").alias("_sum")) if bits == LEVEL_BITS else \
            rows.join(edge.select("source", "_prefix"), F.col("_s").eqNullSafe(F.col("source"))
                      & (F.col("_p") == F.col("_prefix")), "left_semi") \
                .groupBy("_s", "_p", "_child").agg(F.sum("size").alias("_sum"))
        w = Window.partitionBy("_s").orderBy("_child").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("_cum", F.coalesce(F.sum("_sum").over(w), F.lit(0)))
        over = cells.join(edge.select("source", "_rest", "_before"), F.col("_s").eqNullSafe(F.col("source"))).filter(
            F.col("_before") + F.col("_cum") + F.col("_sum") > F.col("_rest"))
        edge = over.groupBy("source", "_rest").agg(
            F.min(F.struct("_child", (F.col("_before") + F.col("_cum")).alias("b"), "_sum")).alias("m")).select(
            "source", "_rest", F.col("m._child").alias("_prefix"), F.col("m.b").alias("_before"), F.col("m._sum").alias("_sum"))
        # a row per source; written, so that the next level's plan does not hold this one's twice
        edge = stored(edge, "mix-edge", compact=True)
    # the boundary hash itself is taken when that comes nearer to the budget; nothing is where nothing is left to take
    end = edge.filter("_rest > 0").select(F.col("source").alias("_s"),
                      (F.col("_prefix") + (F.col("_before") + F.col("_sum") / 2 <= F.col("_rest")).cast("bigint")).alias("threshold"))
    return t.join(end, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "source", "source_size", "target", "repeats", F.coalesce("threshold", F.lit(0).cast("bigint")).alias("threshold"))


def units_of(docs: DataFrame, doc_id: str, text: str, source: str, seed: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                       unit_hash(F.col(doc_id), F.col(text), seed).alias("h"))


def plan(units: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """The per-source table of ``thresholds`` for a table of units, written once."""
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(stored(sizes, "mix-sizes", compact=True), weights, cap), "mix-targets", compact=True)
    return stored(thresholds(units, targets), "mix-thresholds", compact=True)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: str = "mix-1") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, repeats, taken."""
    units = stored(units_of(docs, doc_id, text, source, seed), "mix-units")
    p = plan(units, weights, cap).withColumnRenamed("source", "_s")
    repeats = F.col("repeats") + (F.col("h") < F.col("threshold")).cast("bigint")
    return units.join(p, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"), (F.col("size") * repeats).alias("taken"))


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: str = "mix-1") -> DataFrame:
    """The mix itself: the input rows with all their columns, each as often as it is taken."""
    units = stored(units_of(docs, doc_id, text, source, seed), "mix-units")
    p = plan(units, weights, cap).select(F.col("source").alias("_mix_s"), F.col("repeats").alias("_mix_q"),
                                         F.col("threshold").alias("_mix_t"))
    h = unit_hash(F.col(doc_id), F.col(text), seed)
    rows = docs.withColumn("_mix_h", h).join(p, F.col(source).eqNullSafe(F.col("_mix_s")))
    n = (F.col("_mix_q") + (F.col("_mix_h") < F.col("_mix_t")).cast("bigint")).cast("int")
    return rows.withColumn("_mix_n", n).filter("_mix_n > 0").withColumn(
        "_mix_i", F.explode(F.sequence(F.lit(1), F.col("_mix_n")))).select(*[F.col(f"`{c}`") for c in docs.columns])
