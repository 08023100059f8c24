"""Chat formatting by quotation linking.

Messages quote earlier ones in lines that begin with ``>``, nested by further marks.  A message's
quoted lines are cut into passages (runs of one level, ended by a blank line); passages and
their lines are normalised (lower case, single spaces) and hashed, and joined with the hashed
bodies, paragraphs and lines of the other messages of the conversation.  The original of a
passage is the latest earlier message that contains it.  A message replies to
the original that most of its outermost linked passages come from (by characters, then the latest).  Following
replies upwards gives the thread (its first turn) and the depth; in the order conversation, thread,
turn every reply stands behind its original.  Bodies lose quoted lines and the "... wrote:" line before them.

Everything is built from DataFrame operations.  Scale: only messages of conversations that quote are taken
apart; keys that no quotation holds are dropped before the originals are grouped; the latest earlier
occurrence is found in two steps, by stretches of ``STRETCH`` turns and inside one, so a
line that a third of all messages share never meets its own copies pairwise; roots are found by pointer
doubling, in as many rounds as the logarithm of the longest chain; a conversation is never gathered into one row.

Defined results: null text has a null body and quotes nothing; messages with a null conversation or turn
neither quote nor are quoted; rows that repeat conversation, turn and text link alike; of different texts
with one turn each may be quoted, and replies name the turn; a quotation without an original is
dropped from the body all the same; an empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastespark.llm.common import stored

MARKS = r"^([ \t]*>)*"
QUOTES = r"(?m)^[ \t]*>"
BLANKS = r"[ \t\x0B\f\r]+"
ATTRIBUTION = r"(?i)\bwrote:[ \t]*$"
#: Turns of one stretch in the search for the latest earlier occurrence.
STRETCH = 256


def level(line: Column) -> Column:
    """Nesting of a line: the marks it begins with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def normal(line: Column) -> Column:
    """A line without marks, in lower case, with single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, MARKS, "")), BLANKS, " "))


def lines_of(text: Column) -> Column:
    return F.split(text, "\r?\n", -1)


def own_lines(lines: Column) -> Column:
    """Lines that are not quoted, without the attribution that introduces a quotation."""
    return F.filter(lines, lambda x, i: (level(x) == 0) & ~(x.rlike(ATTRIBUTION) & F.coalesce(level(F.get(lines, i + 1)) > 0, F.lit(False))))


def body(text: Column) -> Column:
    """The message without quotations."""
    clean = F.regexp_replace(F.array_join(own_lines(lines_of(text)), "\n"), r"^\s+|\s+$", "")
    return F.when(text.rlike(QUOTES), clean).otherwise(text)


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]


def _runs(lines: DataFrame, *by: str) -> DataFrame:
    """``run``: number of the run of equal ``level`` without blank lines; a message's own lines only."""
    w = Window.partitionBy("conv", "turn", "th", *by).orderBy("i")
    start = (F.col("norm") == "") | (F.coalesce(F.lag("level").over(w), F.lit(-1)) != F.col("level"))
    return lines.withColumn("run", F.sum(start.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("norm <> ''")


def _joined(lines: DataFrame, *by: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("i", "norm")))
    return lines.groupBy("conv", "turn", "th", *by).agg(F.array_join(F.transform(parts, lambda x: x["norm"]), " ").alias("piece"))


def quotations(messages: DataFrame) -> DataFrame:
    """conv, turn, th, level, h1, h2, weight: every quoted passage and quoted line.  ``messages``: conv, turn, th, text."""
    lines = messages.filter(F.col("text").rlike(QUOTES)).select("conv", "turn", "th", F.posexplode(lines_of(F.col("text"))).alias("i", "line")) \
        .select("conv", "turn", "th", "i", level(F.col("line")).alias("level"), normal(F.col("line")).alias("norm"))
    # an own line between two quotations of a level ends the first one: runs are counted over all lines
    quoted = _runs(lines).filter("level > 0")
    passages = _joined(quoted, "level", "run").select("conv", "turn", "th", "level", "piece")
    both = passages.unionByName(quoted.select("conv", "turn", "th", "level", F.col("norm").alias("piece")))
    return both.select("conv", "turn", "th", "level", *_key(F.col("piece")), F.length("piece").cast("bigint").alias("weight"))


def originals(messages: DataFrame) -> DataFrame:
    """conv, turn, h1, h2: bodies, paragraphs and lines that can be quoted."""
    own = F.transform(own_lines(lines_of(F.col("text"))), lambda x, i: F.struct(i.alias("i"), normal(x).alias("norm")))
    lines = messages.select("conv", "turn", "th", F.explode(own).alias("l")).select(
        "conv", "turn", "th", "l.i", F.lit(0).alias("level"), "l.norm")
    full = _runs(lines)
    pieces = _joined(full).select("conv", "turn", "piece").unionByName(_joined(full, "run").select("conv", "turn", "piece")) \
        .unionByName(full.select("conv", "turn", F.col("norm").alias("piece")))
    return pieces.select("conv", "turn", *_key(F.col("piece"))).distinct()


def latest_before(quotes: DataFrame, units: DataFrame) -> DataFrame:
    """``quotes`` (conv, h1, h2, turn and more) with ``source``: the latest turn before, of a unit with the same key."""
    key = ["conv", "h1", "h2"]
    stretch = F.floor(F.col("turn") / STRETCH).alias("stretch")
    inside = units.select(*key, "turn", stretch).groupBy(*key, "stretch").agg(
        F.sort_array(F.collect_set("turn")).alias("turns"), F.max("turn").alias("top"))
    asked = quotes.select(*key, stretch).distinct()
    w = Window.partitionBy(*key).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    steps = asked.join(inside, [*key, "stretch"], "full").select(
        *key, "stretch", "turns", F.last("top", ignorenulls=True).over(w).alias("earlier"))
    j = quotes.withColumn("stretch", F.floor(F.col("turn") / STRETCH)).join(steps, [*key, "stretch"])
    here = F.array_max(F.filter("turns", lambda x: x < F.col("turn")))
    return j.withColumn("source", F.coalesce(here, F.col("earlier"))).drop("turns", "earlier", "stretch").filter("source IS NOT NULL")


def replies(messages: DataFrame) -> DataFrame:
    """conv, turn, th, reply_to for messages whose quotations have an original."""
    quotes = stored(quotations(messages), "chat-quotes")
    quoting = messages.join(quotes.select("conv").distinct(), "conv", "left_semi")
    units = originals(quoting).join(quotes.select("conv", "h1", "h2").distinct(), ["conv", "h1", "h2"], "left_semi")
    linked = latest_before(quotes, units)
    votes = linked.groupBy("conv", "turn", "th", "level", "source").agg(F.sum("weight").alias("weight"))
    best = votes.groupBy("conv", "turn", "th").agg(F.max(F.struct((-F.col("level")).alias("l"), "weight", "source")).alias("b"))
    return best.select("conv", "turn", "th", F.col("b.source").alias("reply_to"))


def threads(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """conv, turn, thread, depth of every replying turn, by pointer doubling.  ``links``: conv, turn, reply_to."""
    up = stored(links.groupBy("conv", "turn").agg(F.max("reply_to").alias("top")).withColumn("depth", F.lit(1).cast("bigint")), "chat-up")
    for _ in range(max_rounds):
        above = up.select("conv", F.col("turn").alias("top"), F.col("top").alias("higher"), F.col("depth").alias("more"))
        nxt = up.join(above, ["conv", "top"], "left").select(
            "conv", "turn", F.coalesce("higher", "top").alias("top"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("higher").isNotNull().alias("moved"))
        nxt = stored(nxt, "chat-up")
        moved = not nxt.filter("moved").isEmpty()
        up = nxt.drop("moved")
        if not moved:
            return up.withColumnRenamed("top", "thread")
    raise RuntimeError("reply chains did not settle")


def format_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``df`` plus ``body``, ``n_quotes`` (quoted lines), ``max_level``, ``reply_to``, ``thread``, ``depth`` (columns of these names are replaced)."""
    made = ["body", "n_quotes", "max_level", "reply_to", "thread", "depth"]
    cols = [c for c in df.columns if c not in made]
    t = F.col(f"`{text}`")
    messages = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"), F.xxhash64(t).alias("th"),
                         t.alias("text")).filter("conv IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL").distinct()
    reply = stored(replies(messages), "chat-replies")
    up = threads(reply).alias("u")
    r = reply.alias("r")
    d = df.select(*[F.col(f"`{c}`") for c in cols], F.col(f"`{conv}`").alias("_conv"), F.col(f"`{turn}`").cast("bigint").alias("_turn"),
                  F.xxhash64(t).alias("_th")).alias("d")
    j = d.join(r, (F.col("d._conv") == F.col("r.conv")) & (F.col("d._turn") == F.col("r.turn")) & (F.col("d._th") == F.col("r.th")), "left") \
        .join(up, (F.col("d._conv") == F.col("u.conv")) & (F.col("r.reply_to").isNotNull()) & (F.col("d._turn") == F.col("u.turn")), "left")
    text_col = F.col(f"d.`{text}`")
    levels = F.transform(lines_of(text_col), level)
    quoted = F.when(text_col.rlike(QUOTES), F.filter(levels, lambda x: x > 0)).otherwise(F.array().cast("array<int>"))
    return j.select(*[F.col(f"d.`{c}`") for c in cols], body(text_col).alias("body"), F.size(quoted).cast("bigint").alias("n_quotes"),
                    F.coalesce(F.array_max(quoted), F.lit(0)).cast("bigint").alias("max_level"), F.col("r.reply_to").alias("reply_to"),
                    F.coalesce("u.thread", "d._turn").alias("thread"), F.coalesce("u.depth", F.lit(0)).cast("bigint").alias("depth"))


def reply_ordered(formatted: DataFrame, conv: str = "conv_id", turn: str = "turn", partitions: int | None = None) -> DataFrame:
    """Rows in reply order, for writing: ranges of (conversation, thread, turn), sorted; a long conversation spans partitions."""
    order = [conv, "thread", turn]
    out = formatted.repartitionByRange(partitions, *order) if partitions else formatted.repartitionByRange(*order)
    return out.sortWithinPartitions(*order)
