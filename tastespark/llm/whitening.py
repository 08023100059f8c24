"""Embedding whitening by QDWH spectral divide and conquer.

Entries are fixed to integers ``x = floor(64 c) + 1000000``.  The covariance of the distinct vectors is summed in whole
numbers around the integers next to the mean, so it is exact until it is rounded once to double precision,
whatever the order of rows or tasks.  Its spectrum is divided by polar decompositions: the polar factor U of
``A - s I``, found by QR-based dynamically weighted Halley iterations, is the matrix sign of the shifted covariance, so
``(U + I) / 2`` projects on the invariant subspace of the eigenvalues above s; bases of it and of its complement reduce A to two
smaller blocks, which are divided again until they are diagonal.  Every step is orthogonal, so the assembled vectors
are as exact as double precision allows.  The components are then broadcast and every row is whitened where it is read.

Scale: distinct vectors are one aggregate with map-side partial results (a vector that a third of the rows share is
a row per task); sums are one row of d^2 numbers per task, added by position; only d^2 sums reach the
driver, and d x 16 numbers are broadcast, whatever the number of rows.  The division works on one d x d matrix.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are left out, and rows whose vector
is of another length than most distinct vectors (ties: the shorter); ``|64 c|`` is bounded by 2^50; rows with a null or
repeated vec_id are handled one by one; components whose variance is below 1e-12 of the largest are left out (all of
them for fewer than two distinct vectors: no rows); a deviation beyond a long is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastespark.llm.common import make_room, prepare, stored

SCALE, OFFSET, BOUND = 64, 1_000_000, 1 << 50
#: Components that are kept at most, and the least share of the largest variance.
COMPONENTS, LEAST_SHARE = 16, 1e-12
_EPS = float(np.finfo(np.float64).eps)


# --- spectral divide and conquer on one symmetric matrix ---------------------------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH; singular values of at least eps times the largest converge."""
    d = len(a)
    x = a / np.linalg.norm(a)
    low, eye = _EPS, np.eye(d)
    for _ in range(12):
        l2 = low * low
        t = np.cbrt(4 * (1 - l2) / (l2 * l2))
        root = np.sqrt(1 + t)
        wa = root + np.sqrt(max(8 - 4 * t + 8 * (2 - l2) / (l2 * root), 0.0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))[0]
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:d] @ q[d:].T)
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(low * (wa + wb * l2) / (1 + wc * l2), 1.0)
        if 1 - low < 10 * _EPS and moved < _EPS ** (1 / 3):
            break
        low = min(low, 1 - _EPS)
    return x


def _divided(a: np.ndarray, scale: float, rng: np.random.Generator) -> np.ndarray:
    """Orthonormal columns that make ``a`` diagonal to within rounding of ``scale``."""
    d = len(a)
    off = a - np.diag(np.diag(a))
    if d == 1 or np.linalg.norm(off) <= _EPS * scale:
        return np.eye(d)
    spread = np.linalg.norm(a - np.trace(a) / d * np.eye(d))
    best = None
    # the mean of the eigenvalues lies between the least and the largest; the median divides more evenly
    for shift in (float(np.median(np.diag(a))), float(np.trace(a) / d), *(np.trace(a) / d + spread * rng.uniform(-0.3, 0.3, 6))):
        u = polar_factor(a - shift * np.eye(d))
        p = (u + np.eye(d)) / 2
        r = int(round(float(np.trace(p))))
        if not 0 < r < d:
            continue
        basis = np.linalg.qr(p @ rng.standard_normal((d, d)))[0]
        v = np.linalg.qr(np.hstack([p @ basis[:, :r], basis[:, r:] - p @ basis[:, r:]]))[0]
        left = np.linalg.norm(v[:, r:].T @ a @ v[:, :r])
        if best is None or left < best[0]:
            best = left, v, r
        if left <= 100 * _EPS * scale:
            break
    if best is None:
        return np.eye(d)               # eigenvalues that no shift tells apart
    _, v, r = best
    one, two = v[:, :r], v[:, r:]
    return np.hstack([one @ _divided(_symmetric(one.T @ a @ one), scale, rng), two @ _divided(_symmetric(two.T @ a @ two), scale, rng)])


def _symmetric(a: np.ndarray) -> np.ndarray:
    return (a + a.T) / 2


def spectral_components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors (columns) of a symmetric matrix."""
    scale = float(np.linalg.norm(v))
    if scale == 0:
        return np.zeros(len(v)), np.eye(len(v))
    q = _divided(v, scale, np.random.default_rng(7))
    e = np.einsum("ij,ij->j", q, v @ q)
    order = np.argsort(-e, kind="stable")
    return e[order], q[:, order]


# --- sums over rows ---------------------------------------------------------------------------------------------

def grid(vector: Column) -> Column:
    """Entries as integers; null where the vector takes no part."""
    ok = F.forall(vector, lambda c: F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    at = F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(BOUND))), F.lit(-float(BOUND)))) + OFFSET)
    return F.when(F.coalesce(ok & (F.size(vector) > 0), F.lit(False)), at)


def _rows(batch_column: pa.Array, d: int) -> np.ndarray:
    return batch_column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _exact_products(y: np.ndarray) -> np.ndarray:
    """Sum of the outer products of integer rows, as Python integers: products of doubles while every sum stays below 2^53."""
    most = int(np.abs(y).max(initial=0)) + 1
    if most >= 1 << 25:
        big = y.astype(object)
        return big.T @ big
    step, out = max((1 << 52) // (most * most), 1), np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for i in range(0, len(y), step):
        f = y[i:i + step].astype(np.float64)
        out += (f.T @ f).astype(np.int64).astype(object)
    return out


def _sum_by_position(parts: DataFrame, size: int) -> list[int]:
    """Sum of the arrays ``v`` (decimal) of all rows, position by position."""
    sums = parts.select(F.posexplode("v").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = [0] * size
    for r in sums:
        out[r["i"]] = int(r["v"])
    return out


@dataclass
class Whitening:
    """``n`` distinct vectors with sums ``s`` by dimension; eigenvalues and unit components (columns) of their covariance."""

    n: int
    s: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def count(self) -> int:
        return len(self.values)


def covariance(fit: DataFrame, n: int, d: int) -> tuple[list[int], np.ndarray]:
    """Sums by dimension and the covariance (divisor n) of the rows ``x`` (integers)."""
    exact = pa.decimal128(38, 0)
    sums = fit.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect()
    s = [0] * d
    for r in sums:
        s[r["i"]] = int(r["s"])
    near = [(2 * t + n) // (2 * n) for t in s]        # the integers next to the mean
    centre = np.array(near, dtype=np.int64)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        total = np.zeros((d, d), dtype=object)
        for batch in batches:
            if batch.num_rows:
                total = total + _exact_products(_rows(batch.column(0), d) - centre)
        values = pa.array([Decimal(int(t)) for t in total.ravel()], exact)
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, d * d], pa.int32()), values)], ["v"])

    around = _sum_by_position(fit.select("x").mapInArrow(scatter, "v array<decimal(38,0)>"), d * d)
    # n^2 times the covariance is a whole number: what is left of the mean is taken off before the one rounding
    rest = [t - n * m for t, m in zip(s, near)]
    v = np.array([[float(Fraction(n * around[i * d + j] - rest[i] * rest[j], n * n)) for j in range(d)] for i in range(d)])
    return s, v


def _centred(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """x - S/n: the whole part of the mean is taken off in integers."""
    near = s // n
    return (x - near) - (s - near * n) / n


def fit_whitening(fit: DataFrame, n: int, d: int, most: int = COMPONENTS) -> Whitening:
    """``fit``: the distinct vectors ``x``, n rows of d integers."""
    s, v = covariance(fit, n, d)
    e, q = spectral_components(v)
    keep = [i for i in range(min(most, d)) if e[0] > 0 and e[i] > LEAST_SHARE * e[0]]
    w = Whitening(n, s, e[keep], q[:, keep], float(np.trace(v)))
    if keep:
        w.identity_error = _identity_error(fit, w)
    return w


def _identity_error(fit: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened distinct vectors minus the identity."""
    k, d = w.count, len(w.s)
    project = w.vectors / np.sqrt(w.values)
    s = np.array(w.s, dtype=np.int64)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            y = _centred(_rows(batch.column(0), d), w.n, s) @ project if batch.num_rows else np.zeros((0, k))
            total += np.vstack([y.T @ y, y.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["v"])

    parts = fit.select("x").mapInArrow(products, "v array<double>").select(F.posexplode("v").alias("i", "v"))
    total = np.zeros((k + 1) * k)
    for r in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():
        total[r["i"]] = r["v"]
    total = total.reshape(k + 1, k) / w.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def distinct_vectors(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """The distinct vectors ``x`` of the most frequent length, their number, and that length."""
    fit = stored(rows.select("x").distinct(), "whitening-distinct")
    best = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if best is None:
        return fit, 0, 0
    return fit.filter(F.size("x") == best["d"]), best["count"], best["d"]


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    prepare(spark)
    rows = embeddings.select(F.col(f"`{vec_id}`").alias("vec_id"), grid(F.col(f"`{vector}`")).alias("x")).filter("x IS NOT NULL")
    kind = embeddings.schema[vec_id].dataType.simpleString()
    fit, n, d = distinct_vectors(rows)
    w = fit_whitening(fit, n, d, most) if n else Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    shared = spark.sparkContext.broadcast(w)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        w = shared.value
        k = w.count
        for batch in batches:
            m = batch.num_rows
            s = np.array(w.s, dtype=np.int64)
            x = _rows(batch.column(1), d) if m else np.zeros((0, d), dtype=np.int64)
            out = _centred(x, w.n, s) @ (w.vectors / np.sqrt(w.values)) if k else np.zeros((m, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.repeat(np.array(_deviations(x, w.n, w.s), dtype=object), k), pa.int64()), pa.array(out.ravel()),
                 pa.array(np.tile(w.values / w.trace if k else w.values, m))],
                ["vec_id", "component", "deviation", "whitened", "explained"])

    out = rows.filter(F.size("x") == d).mapInArrow(
        project, f"vec_id {kind}, component int, deviation bigint, whitened double, explained double")
    return out.select("vec_id", "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", "explained",
                      F.lit(w.identity_error).alias("identity_error"))


def _deviations(x: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond a long."""
    centre = np.array([t // n for t in s] if n else [], dtype=np.int64)
    rest = [t % n for t in s] if n else []
    y = x - centre
    if n * (int(np.abs(y).max(initial=0)) + 1) < (1 << 31) // max(len(s), 1):
        z = y * n - np.array(rest, dtype=np.int64)
        return (z * z).sum(axis=1).tolist()
    exact = ((y.astype(object) * n - np.array(rest, dtype=object)) ** 2).sum(axis=1) if y.size else []
    return [int(t) if t < 1 << 63 else None for t in exact]
