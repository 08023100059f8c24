"""Embedding near-duplicates by collision-counting projections.

Unit vectors with cosine at least ``t`` lie within ``d = sqrt(2 - 2t)`` of each other, so on a
random line their projections differ by a normal deviate of scale ``d`` at most.  Vectors
are compared only inside their label: the label's rows are sorted by a first
projection and cut into cells of ``cell_rows``, and two cells meet only where the first
projection's windows reach from one into the other.  In such a meeting every one of
``lines`` further projections is sorted, each vector's window of half-width ``1.5 d`` is
found by binary search, and collisions are counted per pair.  Pairs that reach the
calibrated count are verified by exact cosine.  A pair at cosine ``t`` is lost if its cells
do not meet or its count falls short: reach and count are set so that it is found with
probability ``recall`` or more by both together.

What leaves a meeting is bounded by its rows: link counts per vector and a spanning forest of
the verified links, never the links themselves; so a group of copies with n^2 links
gives n rows per meeting.  Equal vectors are one class with a weight.

The work inside a label is quadratic by the nature of one-dimensional windows (at cosine
0.93 a window spans a constant share of the rows); it is spread evenly because cells have equal
sizes by exact rank, however the label's rows are distributed.

Defined results: rows whose label or id is null, and vectors that are null, empty, zero or
hold null or non-finite components, link with nothing; a row with a null id has no
component and is kept; vectors of different lengths do not link; repeated rows (equal id)
count once as links; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from math import comb, erf, sqrt
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastespark.llm.common import components, parallelism, prepare, stored
from tastespark.llm.vectors import hashed, matrix, unit, valid_vector
from tastespark.plans.indexing import row_number_unbounded

#: Half-width of a counting window in units of the distance bound.
WINDOW = 1.5
#: Share of the loss that ``recall`` allows which cells that do not meet may take; the count has the rest.
REACH_SHARE = 0.4


def collision_threshold(lines: int, recall: float) -> int:
    """Largest count that ``lines`` windows reach with probability ``recall`` for a pair at the bound."""
    p = erf(WINDOW / sqrt(2))
    tail, count = 0.0, lines + 1
    while count > 0 and tail < recall:
        count -= 1
        tail += comb(lines, count) * p ** count * (1 - p) ** (lines - count)
    return count


def reach_and_count(lines: int, recall: float) -> tuple[float, int]:
    """Reach of the first projection, in units of the distance bound, and the collision count: a pair at the bound, whose
    projections are independent normal deviates, lies within the reach and has the count with probability ``recall``."""
    apart = REACH_SHARE * (1 - recall)
    return NormalDist().inv_cdf(1 - apart / 2), collision_threshold(lines, recall / (1 - apart))


def collision_pairs(a: np.ndarray, b: np.ndarray, half: float, count: int) -> np.ndarray:
    """Boolean matrix of the pairs (row of ``a``, row of ``b``) whose projections (columns) collide at
    least ``count`` times: per line, ``b`` is sorted and each of ``a`` has a window of its ranks."""
    hits = np.zeros((len(a), len(b)), dtype=np.uint8)
    for line in range(a.shape[1]):
        order = np.argsort(b[:, line], kind="stable")
        rank = np.empty(len(b), dtype=np.uint16)
        rank[order] = np.arange(len(b), dtype=np.uint16)
        lo = np.searchsorted(b[order, line], a[:, line] - half, "left").astype(np.uint16)
        hi = np.searchsorted(b[order, line], a[:, line] + half, "right").astype(np.uint16)
        hits += (rank[None, :] - lo[:, None]) < (hi - lo)[:, None]
    return hits >= count


def verified(a: np.ndarray, b: np.ndarray, pairs: np.ndarray, least: float) -> np.ndarray:
    """The pairs with cosine at least ``least``; ``a`` and ``b`` are unit rows."""
    rows, cols = np.nonzero(pairs)
    if len(rows) > pairs.size // 32:
        return pairs & (a @ b.T >= least)
    out = np.zeros_like(pairs)
    for s in range(0, len(rows), 1 << 16):
        r, c = rows[s:s + (1 << 16)], cols[s:s + (1 << 16)]
        out[r, c] = np.einsum("ij,ij->i", a[r], b[c]) >= least
    return out


def spanning_edges(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(node, smallest node of its component) for the bipartite link matrix between node ids."""
    la, lb = left.copy(), right.copy()
    none = np.iinfo(np.int64).max
    use_a, use_b = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
    m, la_u, lb_u = links[np.ix_(use_a, use_b)], la[use_a], lb[use_b]
    while len(use_a):
        na = np.minimum(la_u, np.where(m, lb_u[None, :], none).min(axis=1))
        nb = np.minimum(lb_u, np.where(m, na[:, None], none).min(axis=0))
        if (na == la_u).all() and (nb == lb_u).all():
            break
        la_u, lb_u = na, nb
    both = np.concatenate([np.stack([left[use_a], la_u], 1), np.stack([right[use_b], lb_u], 1)])
    return both[both[:, 0] != both[:, 1]]


def links(df: DataFrame, least: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
          lines: int = 32, recall: float = 0.9999, cell_rows: int = 2048, seed: int = 11) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, link counts, edges): ``classes`` has h1, h2, cid, weight; ``counts`` has cid, n
    (other vectors linked, equal ones excepted); ``edges`` has a, b (class ids) and spans all links."""
    spark = df.sparkSession
    prepare(spark)
    rows = hashed(df.filter(F.col(f"`{label}`").isNotNull()), vec_id, vector, label)
    if label != "label":
        rows = rows.withColumnRenamed(label, "label")
    classes = stored(rows.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("cid"), F.count_distinct("vec_id").alias("weight"), F.any_value("label").cast("string").alias("label"),
        F.any_value("v").alias("v")), "neardup-classes")
    bound = sqrt(2 - 2 * least)
    far, count = reach_and_count(lines, recall)
    half, reach = WINDOW * bound, far * bound

    def directions(dim: int) -> np.ndarray:
        """Column 0 orders the cells, the others count collisions."""
        return np.random.default_rng([seed, dim]).normal(size=(dim, lines + 1))

    @F.pandas_udf("double")
    def first_projection(v: pd.Series) -> pd.Series:
        return pd.Series([float((unit(matrix([x])) @ directions(len(x))[:, :1])[0, 0]) for x in v]) if v.map(len).nunique() > 1 \
            else pd.Series((unit(matrix(v)) @ directions(len(v.iloc[0]))[:, :1])[:, 0] if len(v) else [], dtype="float64")

    # exact rank inside the label, by a distributed sort: cells are equally large whatever the label's size
    placed = classes.select("h1", "h2", F.concat_ws(":", F.size("v"), "label").alias("part"), first_projection("v").alias("at"))
    ranked = row_number_unbounded(placed, ["part"], [F.col("at"), F.col("h1"), F.col("h2")], "r")
    ranked = stored(ranked.withColumn("cell", F.floor((F.col("r") - 1) / cell_rows)), "neardup-ranks")
    cells = ranked.groupBy("part", "cell").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))

    def reaches(pdf: pd.DataFrame) -> pd.DataFrame:
        """First and last cell that each cell of a label meets; a row per ``cell_rows`` vectors."""
        pdf = pdf.sort_values("cell")
        lo, hi = pdf["lo"].to_numpy(), pdf["hi"].to_numpy()
        pdf["last"] = np.searchsorted(lo, hi + reach, "right") - 1
        pdf["first"] = np.searchsorted(hi, lo - reach, "left")
        return pdf[["part", "cell", "first", "last"]]

    span = cells.groupBy("part").applyInPandas(reaches, "part string, cell bigint, first bigint, last bigint")
    each = ranked.join(span, ["part", "cell"]).join(classes, ["h1", "h2"]).select(
        "part", "cell", "cid", "weight", "v", F.explode(F.sequence("first", "last")).alias("other"))
    meet = each.select("part", F.least("cell", "other").alias("i"), F.greatest("cell", "other").alias("j"), "cell", "cid", "weight", "v")
    meet = meet.repartition(4 * parallelism(spark), "part", "i", "j")

    def meeting(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        v = unit(matrix(pdf["v"]))
        h = v @ directions(v.shape[1])[:, 1:]
        cell, cid, weight = pdf["cell"].to_numpy(), pdf["cid"].to_numpy(), pdf["weight"].to_numpy()
        a = np.flatnonzero(cell == i)
        b = a if i == j else np.flatnonzero(cell == j)
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="Int64"), "n": pd.Series(dtype="int64")})
        m = collision_pairs(h[a], h[b], half, count)
        if i == j:
            m[np.arange(len(a)), np.arange(len(a))] = False
        m = verified(v[a], v[b], m, least)
        n = m @ weight[b] if i == j else np.concatenate([m @ weight[b], weight[a] @ m])
        who = cid[a] if i == j else np.concatenate([cid[a], cid[b]])
        e = spanning_edges(m, cid[a], cid[b])
        some = n > 0
        return pd.DataFrame({"a": np.concatenate([who[some], e[:, 0]]),
                             "b": pd.array([None] * int(some.sum()) + list(e[:, 1]), dtype="Int64"),
                             "n": np.concatenate([n[some], np.zeros(len(e), np.int64)])})

    out = stored(meet.groupBy("part", "i", "j").applyInPandas(meeting, "a bigint, b bigint, n bigint"), "neardup-links")
    counts = out.filter("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    return classes, counts, out.filter("b IS NOT NULL").select("a", "b")


def near_duplicates(df: DataFrame, least: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    **options) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept."""
    classes, counts, edges = links(df, least, vec_id, vector, label, **options)
    comp = components(df.sparkSession, edges, "neardup")
    known = classes.join(counts, "cid", "left").join(comp, F.col("cid") == F.col("node"), "left").select(
        "h1", "h2", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "cid").alias("component_id"))
    rows = hashed(df.filter(F.col(f"`{label}`").isNotNull()), vec_id, vector, label).select("vec_id", "h1", "h2")
    linked = rows.join(known, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    takes_part = F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{label}`").isNotNull() & valid_vector(F.col(f"`{vector}`"))
    alone = df.filter(~F.coalesce(takes_part, F.lit(False))).select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"),
                                                                   F.lit(0).cast("bigint").alias("n_links"),
                                                                   F.col(f"`{vec_id}`").cast("bigint").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
