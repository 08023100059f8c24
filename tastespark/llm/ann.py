"""Approximate nearest neighbours by shifted space-filling curves.

Each ordering projects unit vectors onto a few random orthonormal directions, squashes and
shifts the coordinates, and walks them along a Hilbert curve: one long key per
vector and ordering.  Spark deals the rows of an ordering by ranges of that key
into cells of about ``cell_rows`` rows; a query visits the cells that its key
window (``width`` of all rows to either side) touches, every cell ranks its rows for its
visitors by exact cosine, and the windows of all orderings merge per query.

The window width is fitted at the size of the table: for ``FIT_QUERIES`` rows, chosen by hash, one scan of all
rows finds the true neighbours and their places in every ordering; the width is the smallest that holds
``recall`` of them in one of the orderings.  So it shrinks as neighbourhoods grow denser, and the recall is measured against
brute force by the fit itself.  Every row is indexed.  On data without neighbourhood structure
(independent random vectors) no curve can do better than to scan a constant share
of the rows; the fitted width then says so (README has figures).

Scale: rows with equal vectors form one class that keeps its smallest ids, so a
vector shared by a third of all rows is one row; equal keys of unequal vectors are
spread over the cells that their share of the sample spans; a cell with many
visitors is dealt again by blocks of queries.  A task holds one cell and one block.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows with null ids, take no part; vectors of different lengths are not
compared; repeated rows count once; ties go to the smaller vec_id; fewer candidates than
``k`` are all returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastespark.llm.common import prepare, stored
from tastespark.llm.vectors import hash_sample, hashed, matrix, unit

#: Projected directions and bits of each in one key.
DIRECTIONS, BITS = 6, 10
#: Rows by which places on the curves are estimated, and queries whose true neighbours fit the window.
SAMPLE_ROWS, FIT_QUERIES = 4096, 256


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of integer grid points (a row each), by the well-known public transform of
    transposed coordinates: the Gray-code walk, axis by axis from the highest bit, on all rows at once."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    for b in range(bits - 1, 0, -1):
        bit, low = 1 << b, (1 << b) - 1
        for i in range(dims):
            upper = (x[:, i] & bit) != 0
            swap = np.where(upper, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(upper, low, swap)
            x[:, i] ^= swap
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        flip = np.where(x[:, -1] & (1 << b), flip ^ ((1 << b) - 1), flip)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


@dataclass
class Curves:
    """Orderings for one vector length: directions, shifts, sorted sample keys."""

    directions: list[np.ndarray]
    shifts: list[np.ndarray]
    sample: list[np.ndarray]

    def keys(self, v: np.ndarray, i: int) -> np.ndarray:
        """``v``: unit rows."""
        spread = 1 / (1 + np.exp(-1.702 * np.sqrt(v.shape[1]) * (v @ self.directions[i])))
        grid = np.minimum(((spread + self.shifts[i]) / 2 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
        return hilbert_keys(grid, BITS)

    def place(self, keys: np.ndarray, i: int, salt: np.ndarray) -> np.ndarray:
        """Share of rows before each key, by the sample: between two sample keys in proportion, and
        for a key that the sample holds several times anywhere in that stretch (``salt`` in [0, 1))."""
        s = self.sample[i]
        lo, hi = np.searchsorted(s, keys, "left"), np.searchsorted(s, keys, "right")
        before = np.where(lo > 0, s[np.maximum(lo - 1, 0)], 0).astype(np.float64)
        after = np.where(lo < len(s), s[np.minimum(lo, len(s) - 1)], 1 << (DIRECTIONS * BITS)).astype(np.float64)
        between = lo - 1 + (keys - before) / np.maximum(after - before, 1)
        at = np.where(hi > lo, lo + salt * (hi - lo), np.maximum(between, 0))
        return np.clip(at / len(s), 0, 1 - 1e-9)


def random_curves(sample: np.ndarray, orderings: int, seed: int) -> Curves:
    """Orderings whose places are estimated by the unit rows ``sample``."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    dims = min(DIRECTIONS, dim)
    directions = [np.linalg.qr(rng.normal(size=(dim, dims)))[0] for _ in range(orderings)]
    directions = [np.hstack([d, np.zeros((dim, DIRECTIONS - dims))]) for d in directions]
    c = Curves(directions, [rng.random(DIRECTIONS) for _ in range(orderings)], [])
    c.sample = [np.sort(c.keys(sample, i)) for i in range(orderings)]
    return c


def _salt(h2: np.ndarray) -> np.ndarray:
    return h2.astype(np.uint64).astype(np.float64) / 2.0 ** 64


def fitted_width(classes: DataFrame, curves, k: int, recall: float) -> float:
    """The smallest window that holds ``recall`` of the true ``k`` nearest among all classes of ``FIT_QUERIES`` of them: a scan
    in which every task keeps its best ``k`` for each query, with their places in the orderings."""
    spark = classes.sparkSession
    some = hash_sample(classes, FIT_QUERIES).select("h1", "h2", "v").collect()
    keys = [(r["h1"], r["h2"]) for r in some]
    asked = unit(matrix([r["v"] for r in some]))
    shared = spark.sparkContext.broadcast((keys, asked))
    orderings = len(curves.value.shifts)

    def places(v: np.ndarray, h2: np.ndarray) -> np.ndarray:
        c = curves.value
        return np.stack([c.place(c.keys(v, i), i, _salt(h2)) for i in range(orderings)], axis=1)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, queries = shared.value
        own = {k: i for i, k in enumerate(keys)}
        best: list[list[tuple]] = [[] for _ in keys]
        for pdf in batches:
            if not len(pdf):
                continue
            v, h1, h2 = unit(matrix(pdf["v"])), pdf["h1"].to_numpy(), pdf["h2"].to_numpy()
            cos, at = queries @ v.T, places(v, h2)
            for j, key in enumerate(zip(h1.tolist(), h2.tolist())):
                if key in own:
                    cos[own[key], j] = -2.0
            top = np.argpartition(-cos, min(k, len(v)) - 1, axis=1)[:, :k]
            for q in range(len(keys)):
                best[q] = sorted([*best[q], *((float(cos[q, j]), at[j].tolist()) for j in top[q] if cos[q, j] > -2)], reverse=True)[:k]
        rows = [(q, s, at) for q, found in enumerate(best) for s, at in found]
        yield pd.DataFrame(rows, columns=["q", "score", "at"])

    found = classes.select("h1", "h2", "v").mapInPandas(scan, "q int, score double, at array<double>")
    w = Window.partitionBy("q").orderBy(F.desc("score"))
    near = found.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).select("q", "at").collect()
    if not near:
        return 1.0
    mine = places(asked, np.array([h for _, h in keys], dtype=np.int64))
    need = [np.abs(mine[r["q"]] - np.array(r["at"])).min() for r in near]
    return float(np.quantile(need, recall))


def search(df: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", orderings: int = 16,
           recall: float = 0.95, cell_rows: int = 2048, query_block: int = 2048, seed: int = 7) -> DataFrame:
    """The ``k`` nearest found of every row for which ``is_query`` holds (a condition on ``vec_id``):
    query_id, rank, vec_id, score (cosine)."""
    spark = df.sparkSession
    prepare(spark)
    rows = hashed(df, vec_id, vector)
    ids = rows.select("h1", "h2", "vec_id").distinct()
    # an id beyond the k + 1 smallest of its class can be nobody's neighbour
    w = Window.partitionBy("h1", "h2").orderBy("vec_id")
    members = stored(ids.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1), "ann-members")
    queries = stored(ids.filter(is_query).select("h1", "h2", F.col("vec_id").alias("query_id")), "ann-queries")
    classes = rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.any_value("v").alias("v"))
    asked = queries.select("h1", "h2").distinct().withColumn("asked", F.lit(True))
    classes = stored(classes.join(asked, ["h1", "h2"], "left").select(
        "h1", "h2", "least", "v", F.size("v").alias("dim"), F.coalesce("asked", F.lit(False)).alias("asked")), "ann-classes")
    sizes = classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("q")).collect()
    found = [_search_length(classes.filter(F.col("dim") == s["dim"]), s["n"], s["q"], k, orderings, recall, cell_rows, query_block, seed)
             for s in sizes if s["q"]]
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    pairs = found[0]
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    best = pairs.groupBy("q1", "q2", "h1", "h2", "least").agg(F.max("score").alias("score"))
    w = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "least")
    best = best.withColumn("c", F.row_number().over(w)).filter(F.col("c") <= k + 1)
    near = best.join(members, ["h1", "h2"]).select("q1", "q2", "vec_id", "score")
    asked_by = queries.select(F.col("h1").alias("q1"), F.col("h2").alias("q2"), "query_id")
    out = asked_by.join(near, ["q1", "q2"]).filter("query_id <> vec_id")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_length(classes: DataFrame, n: int, n_queries: int, k: int, orderings: int, recall: float, cell_rows: int,
                   query_block: int, seed: int) -> DataFrame:
    """Nearest classes of every asked class, for vectors of one length: q1, q2, h1, h2, least, score."""
    spark = classes.sparkSession
    sample = unit(matrix([r["v"] for r in hash_sample(classes, SAMPLE_ROWS).select("v").collect()]))
    curves = spark.sparkContext.broadcast(random_curves(sample, orderings, seed))
    cells = max(1, -(-n // cell_rows))
    width = fitted_width(classes, curves, k, recall) + 1 / n if n > 4 * k else 1.0
    blocks = max(1, int(-(-n_queries * min(1.0, 2 * width + 1 / cells) // query_block)))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = curves.value
        for pdf in batches:
            v = unit(matrix(pdf["v"]))
            salt = _salt(pdf["h2"].to_numpy())
            block = (pdf["h1"].to_numpy() % blocks).astype(np.int32)
            raw = np.array([x.tobytes() for x in matrix(pdf["v"])], dtype=object)
            asked = np.flatnonzero(pdf["asked"].to_numpy())
            for i in range(orderings):
                at = c.place(c.keys(v, i), i, salt)
                first = np.maximum(((at - width) * cells).astype(np.int64), 0)
                last = np.minimum(((at + width) * cells).astype(np.int64), cells - 1)
                visits = np.repeat(asked, last[asked] - first[asked] + 1)
                cell = np.concatenate([np.arange(first[a], last[a] + 1) for a in asked]) if len(asked) else np.zeros(0, np.int64)
                own = np.repeat(np.arange(len(pdf)), blocks)
                take = np.concatenate([own, visits]).astype(np.int64)
                yield pd.DataFrame({
                    "ordering": np.int32(i), "cell": np.concatenate([(at[own] * cells).astype(np.int64), cell]).astype(np.int64),
                    "block": np.concatenate([np.tile(np.arange(blocks, dtype=np.int32), len(pdf)), block[visits]]).astype(np.int32),
                    "visitor": np.concatenate([np.zeros(len(own), bool), np.ones(len(visits), bool)]),
                    "h1": pdf["h1"].to_numpy()[take], "h2": pdf["h2"].to_numpy()[take], "least": pdf["least"].to_numpy()[take],
                    "raw": raw[take]})

    def rank(pdf: pd.DataFrame) -> pd.DataFrame:
        q, c = pdf[pdf["visitor"]], pdf[~pdf["visitor"]]
        names = ["q1", "q2", "h1", "h2", "least", "score"]
        if q.empty or c.empty:
            return pd.DataFrame({x: pd.Series(dtype="float64" if x == "score" else "int64") for x in names})
        qv, cv = (np.frombuffer(b"".join(x["raw"]), dtype=np.float64).reshape(len(x), -1) for x in (q, c))
        qn, cn = unit(qv), unit(cv)
        least = c["least"].to_numpy()
        out = []
        for a in range(0, len(q), 512):
            s = np.minimum(np.maximum(qn[a:a + 512] @ cn.T, -1.0), 1.0)
            cut = np.partition(s, max(0, len(c) - k - 1), axis=1)[:, max(0, len(c) - k - 1)]
            for i in range(len(s)):
                top = np.flatnonzero(s[i] >= cut[i])
                top = top[np.lexsort((least[top], -s[i][top]))][:k + 1]
                out.append((np.full(len(top), a + i), top, s[i][top]))
        qi, ci = np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])
        return pd.DataFrame({"q1": q["h1"].to_numpy()[qi], "q2": q["h2"].to_numpy()[qi], "h1": c["h1"].to_numpy()[ci],
                             "h2": c["h2"].to_numpy()[ci], "least": least[ci], "score": np.concatenate([x[2] for x in out])})

    dealt = classes.select("h1", "h2", "least", "v", "asked").mapInPandas(
        deal, "ordering int, cell bigint, block int, visitor boolean, h1 bigint, h2 bigint, least bigint, raw binary")
    return dealt.groupBy("ordering", "cell", "block").applyInPandas(
        rank, "q1 bigint, q2 bigint, h1 bigint, h2 bigint, least bigint, score double")
