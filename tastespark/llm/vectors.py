"""What the two vector operators share: valid rows, classes of equal vectors, bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_vector(v: Column) -> Column:
    """Not null, not empty, every component finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def hashed(df: DataFrame, vec_id: str, vector: str, *more: str) -> DataFrame:
    """Valid rows as ``vec_id`` (long), ``v`` (array<double>), 128 bits of hash ``h1``, ``h2``, and ``more`` columns.
    Adding zero makes negative zeros equal to zero before hashing."""
    rows = df.filter(F.col(f"`{vec_id}`").isNotNull() & valid_vector(F.col(f"`{vector}`")))
    v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double") + F.lit(0.0))
    return rows.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), *[F.col(f"`{c}`").alias(c) for c in more], v.alias("v")) \
        .withColumns({"h1": F.xxhash64("v", *more), "h2": F.xxhash64(F.lit(1), "v", *more)})


def matrix(vectors) -> np.ndarray:
    """A column of arrays as a matrix of doubles."""
    return np.array([np.asarray(x, dtype=np.float64) for x in vectors]) if len(vectors) else np.zeros((0, 1))


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest component is taken out first, so that squares neither overflow nor vanish."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def hash_sample(classes: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` classes, those with the smallest hashes: an even sample that any rerun repeats."""
    return classes.orderBy("h1", "h2").limit(rows)
