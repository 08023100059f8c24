"""Tile-pair plan for exact all-pairs scoring without a cross join.

Items are hashed into ``T`` tiles of about ``tile_size`` items.  Each item
row is replicated to the ``T`` tile pairs ``(lo, hi)`` that contain its tile
(an equi-join key, one shuffle of ``n * T`` rows), and every tile pair is
scored inside one task with vectorised numpy.  A task therefore holds at most
two tiles, whatever the skew of the data, and only pairs selected by the
caller's rule (threshold and/or per-row top-n) leave the task: the n^2 pair
space is computed but never materialised as rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TILE = "_tile"
LO = "_lo"
HI = "_hi"
PAIR = "_pair"
MAX_PAIR_PARTITIONS = 20000


# tiles are not cut smaller than this only to occupy more cores
MIN_TILE = 256


def n_tiles_for(n_items: int, tile_size: int, spread: int = 1) -> int:
    """Tiles of at most about ``tile_size`` items, and at least ``spread`` of them
    as long as each keeps ``MIN_TILE`` items."""
    return max(1, math.ceil(n_items / max(1, tile_size)), min(spread, n_items // MIN_TILE))


def _cores(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def replicate_to_tile_pairs(items: DataFrame, id_col: str, n_tiles: int) -> DataFrame:
    """Add ``_tile`` and replicate each row to its ``n_tiles`` tile pairs ``(_lo, _hi)``."""
    tiled = items.withColumn(TILE, F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_tiles)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))).alias("_other")
    rep = tiled.select("*", other)
    return rep.select("*", F.least(TILE, "_other").alias(LO), F.greatest(TILE, "_other").alias(HI)).drop("_other")


def score_tile_pairs(items: DataFrame, id_col: str,
                     scorer: Callable[[pd.DataFrame, pd.DataFrame, bool], pd.DataFrame],
                     out_schema: StructType, tile_size: int = 1024,
                     n_items: int | None = None) -> DataFrame:
    """Run ``scorer(left, right, same_tile)`` on every tile pair.

    ``left``/``right`` are the item rows of tile ``lo``/``hi`` (equal objects
    when ``same_tile``), each sorted by ``id_col``.  The scorer returns the
    selected pairs (``select_pairs`` / ``flag_pairs``); symmetric results may
    leave once per unordered pair and be mirrored on the JVM side.
    """
    if n_items is None:
        n_items = items.count()
    # t (t + 1) / 2 tile pairs: enough to occupy every core twice
    t = n_tiles_for(n_items, tile_size, math.ceil(2 * math.sqrt(_cores(items))))
    rep = replicate_to_tile_pairs(items, id_col, t)
    # The scoring stage is CPU-bound while its input is small.  Each tile pair
    # gets a dense index and the rows are range-partitioned on it with an
    # explicit count (AQE does not coalesce it), so every task scores about the
    # same number of tile pairs instead of hash collisions stacking several in
    # one task.  Grouping by the same index reuses that partitioning: no second
    # shuffle.
    n_pairs = t * (t + 1) // 2
    lo, hi = F.col(LO).cast("bigint"), F.col(HI).cast("bigint")
    pair_idx = F.shiftright(lo * (F.lit(2 * t + 1) - lo), 1) + (hi - lo)
    rep = rep.withColumn(PAIR, pair_idx).repartitionByRange(min(n_pairs, MAX_PAIR_PARTITIONS), PAIR)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo = int(pdf[LO].iloc[0])
        hi = int(pdf[HI].iloc[0])
        body = pdf.drop(columns=[LO, HI, PAIR])
        if lo == hi:
            side = body.sort_values(id_col, kind="stable").reset_index(drop=True)
            return scorer(side, side, True)
        left = body[body[TILE] == lo].sort_values(id_col, kind="stable").reset_index(drop=True)
        right = body[body[TILE] == hi].sort_values(id_col, kind="stable").reset_index(drop=True)
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({f.name: pd.Series(dtype=_np_dtype(f)) for f in out_schema.fields})
        return scorer(left, right, False)

    return rep.groupBy(PAIR).applyInPandas(run, out_schema)


def _np_dtype(field) -> str:
    name = field.dataType.typeName()
    return {"long": "int64", "integer": "int32", "double": "float64", "float": "float32"}.get(name, "object")


def select_pairs(score: np.ndarray, ids_l: np.ndarray, ids_r: np.ndarray, same_tile: bool,
                 min_score: float | None, top_n: int | None,
                 names: tuple[str, str, str] = ("id1", "id2", "similarity"),
                 one_direction: bool = False) -> pd.DataFrame:
    """Directed pairs (both directions) kept from a score matrix.

    With ``one_direction`` (threshold only, no ``top_n``) each unordered pair
    is emitted once and the caller mirrors it on the JVM side
    (``mirror_pairs``), which halves what crosses the Python boundary.

    Row i of ``score`` scores ``ids_l[i]`` against every ``ids_r[j]``; both id
    vectors are ascending.  A pair is kept when ``score >= min_score`` (if
    given) and, if ``top_n`` is given, when it is among the ``top_n`` best of
    its row by (score desc, id asc) in this tile pair.  ``same_tile`` means
    left and right are the same items: the diagonal is excluded and rows alone
    cover both directions.
    """
    blocks = []
    mats = [(score, ids_l, ids_r)]
    if one_direction and top_n is None:
        keep = np.isfinite(score) if min_score is None else np.isfinite(score) & (score >= min_score)
        if same_tile:
            keep &= np.triu(np.ones(score.shape, dtype=bool), k=1)
        r, c = np.nonzero(keep)
        return pd.DataFrame({names[0]: ids_l[r].astype("int64"), names[1]: ids_r[c].astype("int64"),
                             names[2]: score[r, c].astype("float64")})
    if same_tile:
        score = score.copy()
        np.fill_diagonal(score, -np.inf)
        mats = [(score, ids_l, ids_r)]
    else:
        mats.append((np.ascontiguousarray(score.T), ids_r, ids_l))
    for m, a, b in mats:
        if m.size == 0:
            continue
        keep = np.isfinite(m)
        if min_score is not None:
            keep &= m >= min_score
        if top_n is not None and top_n < m.shape[1]:
            keep &= row_top_k(np.where(keep, m, -np.inf), top_n)
        r, c = np.nonzero(keep)
        blocks.append(pd.DataFrame({names[0]: a[r].astype("int64"), names[1]: b[c].astype("int64"),
                                    names[2]: m[r, c].astype("float64")}))
    if not blocks:
        return pd.DataFrame({names[0]: pd.Series(dtype="int64"), names[1]: pd.Series(dtype="int64"),
                             names[2]: pd.Series(dtype="float64")})
    return pd.concat(blocks, ignore_index=True)


def row_top_k(m: np.ndarray, k: int) -> np.ndarray:
    """Boolean mask of each row's ``k`` best entries (ties to the smaller column,
    columns being in ascending id order), in linear time per row: the k-th value
    comes from a partition, ties at it are taken left to right."""
    n = m.shape[1]
    if k >= n:
        return np.ones(m.shape, dtype=bool)
    kth = -np.partition(-m, k - 1, axis=1)[:, k - 1]
    greater = m > kth[:, None]
    need = k - greater.sum(axis=1)
    ties = m == kth[:, None]
    return greater | (ties & (np.cumsum(ties, axis=1) <= need[:, None]))


def flag_pairs(score: np.ndarray, ids_l: np.ndarray, ids_r: np.ndarray, same_tile: bool,
               min_score: float, top_n: int,
               names: tuple[str, str, str] = ("id1", "id2", "similarity")) -> pd.DataFrame:
    """Unordered pairs kept because ``score >= min_score`` or because they are in
    the tile-level top ``top_n`` of either endpoint; ``top12`` / ``top21`` tell
    which direction made the cut (``mirror_flagged`` expands them).  One pass
    feeds both a threshold table and an exact top-n table."""
    if same_tile:
        score = score.copy()
        np.fill_diagonal(score, -np.inf)
        top12 = row_top_k(score, top_n) & np.isfinite(score)
        top21 = top12.T                                  # symmetric scores: column view of the row flags
        keep = np.triu(np.ones(score.shape, dtype=bool), k=1)
    else:
        top12 = row_top_k(score, top_n) & np.isfinite(score)
        top21 = row_top_k(np.ascontiguousarray(score.T), top_n).T & np.isfinite(score)
        keep = np.ones(score.shape, dtype=bool)
    above = score >= min_score
    keep &= above | top12 | top21
    r, c = np.nonzero(keep)
    return pd.DataFrame({names[0]: ids_l[r].astype("int64"), names[1]: ids_r[c].astype("int64"),
                         names[2]: score[r, c].astype("float64"), "above": above[r, c],
                         "top12": top12[r, c], "top21": top21[r, c]})


def mirror_flagged(pairs: DataFrame, a: str = "id1", b: str = "id2", v: str = "similarity") -> DataFrame:
    """Directed rows ``(id1, id2, similarity, above, in_top)`` from ``flag_pairs`` output."""
    both = F.explode(F.array(
        F.struct(F.col(a).alias(a), F.col(b).alias(b), F.col("top12").alias("in_top")),
        F.struct(F.col(b).alias(a), F.col(a).alias(b), F.col("top21").alias("in_top")))).alias("_p")
    return pairs.select(both, v, "above").select(
        F.col(f"_p.{a}").alias(a), F.col(f"_p.{b}").alias(b), v, "above", F.col("_p.in_top").alias("in_top"))


def mirror_pairs(pairs: DataFrame, a: str = "id1", b: str = "id2", v: str = "similarity") -> DataFrame:
    """Both directions of symmetric pairs with one generator (no union, no recompute)."""
    both = F.explode(F.array(F.struct(F.col(a).alias(a), F.col(b).alias(b)),
                             F.struct(F.col(b).alias(a), F.col(a).alias(b)))).alias("_p")
    return pairs.select(both, v).select(F.col(f"_p.{a}").alias(a), F.col(f"_p.{b}").alias(b), v)


def score_block_pairs(left: DataFrame, right: DataFrame, scorer: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
                      out_schema: StructType, block_size: int = 4096,
                      n_left: int | None = None, n_right: int | None = None) -> DataFrame:
    """Bipartite form of the tile plan: every (left block, right block) pair is
    scored in one task.  ``left`` and ``right`` share one schema (an ``id``
    column plus payload); left rows are replicated to the right block count and
    right rows to the left block count, range-partitioned by a dense pair index
    (one shuffle), and ``scorer(left_block, right_block)`` returns the selected
    rows.  No cross join; a task holds two blocks."""
    n_left = left.count() if n_left is None else n_left
    n_right = right.count() if n_right is None else n_right
    # blocks of both sides: enough pairs to occupy every core, the longer side cut first
    tr = n_tiles_for(n_right, block_size, 2 * _cores(right))
    tl = n_tiles_for(n_left, block_size, math.ceil(2 * _cores(right) / tr))
    blk = lambda t: F.pmod(F.xxhash64(F.col("id")), F.lit(t))
    lrep = left.select("*", F.lit(0).alias("_side"), blk(tl).alias("_b"),
                       F.explode(F.sequence(F.lit(0), F.lit(tr - 1))).alias("_o")) \
        .withColumn(PAIR, F.col("_b") * tr + F.col("_o")).drop("_b", "_o")
    rrep = right.select("*", F.lit(1).alias("_side"), blk(tr).alias("_b"),
                        F.explode(F.sequence(F.lit(0), F.lit(tl - 1))).alias("_o")) \
        .withColumn(PAIR, F.col("_o") * tr + F.col("_b")).drop("_b", "_o")
    rep = lrep.unionByName(rrep).repartitionByRange(min(tl * tr, MAX_PAIR_PARTITIONS), PAIR)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        side = pdf["_side"].to_numpy()
        body = pdf.drop(columns=["_side", PAIR])
        lb = body[side == 0].sort_values("id", kind="stable").reset_index(drop=True)
        rb = body[side == 1].sort_values("id", kind="stable").reset_index(drop=True)
        if len(lb) == 0 or len(rb) == 0:
            return pd.DataFrame({f.name: pd.Series(dtype=_np_dtype(f)) for f in out_schema.fields})
        return scorer(lb, rb)

    return rep.groupBy(PAIR).applyInPandas(run, out_schema)
