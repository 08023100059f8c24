"""Line deduplication by overlapping windows of three lines.

Lines end at "\\n"; a line's normal form is the line without white space at its
ends, and blank lines belong to no window.  Each document gives one window per
three consecutive non-blank lines, hashed to 128 bits.  A global aggregate names
the first occurrence of every window that occurs more than once (smallest
doc_id, null last, then text hash, then position); every later occurrence covers
its three positions, and the union of covered positions is removed.  A line is
only removed when an earlier copy of it exists, so no line's text is lost from
the corpus.

Window counts are partially aggregated before the shuffle, and the rows of a hot
window meet a one-row build side in a join that adaptive execution may split;
what is gathered per document are positions of its own lines.

Defined results: null text stays null; documents with fewer than three non-blank
lines are unchanged; repeated rows (equal doc_id and text) share occurrences, so
none of them counts as the later one of another; an empty table gives no rows;
input columns of any other name are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastespark.llm.common import stored

WINDOW = 3
#: White space at the ends of a line, the line end excepted.
BLANK = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_windows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per window: ``id``, ``th`` (text hash), ``h1``, ``h2`` and the positions ``pos``."""
    t = F.col(f"`{text}`")
    full = F.filter(F.transform(_lines(t), lambda x, i: F.struct(i.alias("i"), F.trim(x, F.lit(BLANK)).alias("t"))),
                    lambda x: x["t"] != "")
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(t).alias("th"), full.alias("l")).filter(F.size("l") >= WINDOW)

    def window(i: Column) -> Column:
        part = [F.element_at(F.col("l"), i + k) for k in range(1, WINDOW + 1)]
        return F.struct(F.xxhash64(*[p["t"] for p in part]).alias("h1"),
                        F.xxhash64(F.lit("second"), *[p["t"] for p in part]).alias("h2"),
                        F.array(*[p["i"] for p in part]).alias("pos"))

    each = F.explode(F.transform(F.sequence(F.lit(0), F.size("l") - WINDOW), window)).alias("w")
    return rows.select("id", "th", each).select("id", "th", "w.h1", "w.h2", "w.pos")


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document with something to remove: ``id``, ``th`` and the sorted positions ``removed``."""
    w = stored(line_windows(docs, doc_id, text), "line-windows").withColumn(
        "at", F.struct(F.col("id").isNull().alias("n"), "id", "th", F.col("pos")[0].alias("p")))
    first = w.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    later = w.join(first, ["h1", "h2"]).filter(F.col("at") > F.col("first"))
    return later.select("id", "th", F.explode("pos").alias("p")).groupBy("id", "th").agg(
        F.sort_array(F.collect_set("p")).alias("removed"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the text rebuilt from the lines that stay, plus ``n_lines`` and ``n_removed``
    (which replace input columns of those names)."""
    gone = removed_lines(docs, doc_id, text).alias("g")
    cols = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    d = docs.select(*[F.col(f"`{c}`") for c in cols], F.col(f"`{doc_id}`").alias("_line_id"),
                    F.xxhash64(F.col(f"`{text}`")).alias("_line_th"))
    j = d.alias("d").join(gone, F.col("_line_id").eqNullSafe(F.col("g.id")) & (F.col("_line_th") == F.col("g.th")), "left")
    t = F.col(f"d.`{text}`")
    lines = _lines(t)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("g.removed"))
    clean = F.when(F.col("g.removed").isNull(), t).otherwise(
        F.array_join(F.transform(stay, lambda i: F.element_at(lines, i + 1)), "\n"))
    return j.select(*[clean.alias(c) if c == text else F.col(f"d.`{c}`") for c in cols],
                    F.when(t.isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
                    F.coalesce(F.size("g.removed"), F.lit(0)).cast("bigint").alias("n_removed"))
