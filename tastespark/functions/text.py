"""Text column functions: token sets (SC1), title character sets (SC2),
missing markers (SC3), event parsing (PR1, SC15), field picking (PR2, SC12),
JSON access (SC13) and output lines (SC14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "-1"
# Characters that end a title prefix.
TITLE_STOP_LONG = ":："          # the second title of a pair stops at a colon (ASCII or full width)
TITLE_STOP_SHORT = ":： "        # the first title also stops at a space


def token_list(c: Column, cap: int) -> Column:
    """SC1: split on '/', keep the first ``cap`` tokens, drop all spaces, dedupe.

    Trailing '/' are stripped first, because the split this mirrors drops
    trailing empty tokens while Spark's ``split`` keeps them.
    """
    trimmed = F.regexp_replace(c, "/+$", "")
    toks = F.slice(F.split(trimmed, "/"), 1, cap)
    return F.array_distinct(F.transform(toks, lambda x: F.replace(x, F.lit(" "), F.lit(""))))


def is_missing(c: Column) -> Column:
    """SC3: an attribute is missing when NULL or when its first source token is '-1'."""
    first = F.replace(F.split(c, "/").getItem(0), F.lit(" "), F.lit(""))
    return F.coalesce(first == F.lit(MISSING), F.lit(True))


def title_prefix(name: Column, stops: str) -> Column:
    return F.regexp_extract(name, f"^[^{stops}]*", 0)


def char_set(s: Column) -> Column:
    """Distinct characters of a string (empty string -> empty array)."""
    return F.when(F.length(s) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(s, "")))


def title_chars(name: Column, first: bool) -> Column:
    """SC2: character set of a title up to its stop character."""
    return char_set(title_prefix(name, TITLE_STOP_SHORT if first else TITLE_STOP_LONG))


def title_missing(name: Column) -> Column:
    return F.coalesce(name == F.lit(MISSING), F.lit(True))


def first_token(c: Column, sep: str = "/") -> Column:
    """SC12: first '/'-separated token (first genre)."""
    return F.split_part(c, F.lit(sep), F.lit(1))


def pick_field(c: Column, n: int, sep: str = "|") -> Column:
    """PR2: field ``n`` (1-based) of a delimited message, literal separator."""
    return F.split_part(c, F.lit(sep), F.lit(n))


def parse_rating_csv(df: DataFrame, value_col: str = "value") -> DataFrame:
    """PR1 / SC15: ``user,item,rate,epoch_ms`` text to typed columns.

    Uses ``try_cast`` so a malformed field yields NULL instead of failing the
    task; ``_valid`` tells good rows from rejects (see ``split_rejects``).
    """
    parts = F.split(F.col(value_col), ",")
    out = df.select(
        "*",
        F.trim(F.get(parts, F.lit(0))).try_cast("int").alias("user_id"),
        F.trim(F.get(parts, F.lit(1))).try_cast("int").alias("item_id"),
        F.trim(F.get(parts, F.lit(2))).try_cast("double").alias("rate"),
        F.trim(F.get(parts, F.lit(3))).try_cast("bigint").alias("epoch_ms"),
    )
    valid = (F.size(parts) >= 4) & F.col("user_id").isNotNull() & F.col("item_id").isNotNull() \
        & F.col("rate").isNotNull() & F.col("epoch_ms").isNotNull()
    return out.withColumn("_valid", F.coalesce(valid, F.lit(False)))


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of ``parse_rating_csv``."""
    return parsed.filter("_valid").drop("_valid"), parsed.filter("NOT _valid").drop("_valid")


def json_field(c: Column, field: str) -> Column:
    """SC13: one top-level field of a JSON text."""
    return F.get_json_object(c, f"$.{field}")


def csv_line(*cols: Column | str, sep: str = ",") -> Column:
    """SC14: output line of joined fields."""
    return F.concat_ws(sep, *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])


def fmt_decimal(c: Column, digits: int = 2) -> Column:
    """SC11: ``%1.2f``-style number text."""
    return F.format_string(f"%1.{digits}f", c)


def fmt_int(c: Column, width: int = 2) -> Column:
    """SC11: ``%2d``-style number text."""
    return F.format_string(f"%{width}d", c)
