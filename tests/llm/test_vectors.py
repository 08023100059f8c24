"""Nearest neighbours and embedding near-duplicates against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastespark.llm import ann, neardup

SCHEMA = "vec_id long, embedding array<float>, label int, score string, h1 string"
NAN, INF = float("nan"), float("inf")


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosines(rows):
    v = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    n = np.linalg.norm(v, axis=1)
    return (v @ v.T) / n[:, None] / n


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 16))
    out = [(i, base[i % 300].tolist() if i < 300 else (base[i % 300] + rng.normal(size=16) * 0.15).tolist(), int(i % 3), "s", "h") for i in range(900)]
    out += [(1000 + i, base[7].tolist(), 1, "s", "h") for i in range(60)]           # one vector, many times
    out += [(2000, (base[9] * 5).tolist(), 0, "s", "h"), (2000, (base[9] * 5).tolist(), 0, "s", "h")]
    return out


BAD = [(5000, None, 1, "", ""), (5050, [], 1, "", ""), (5100, [0.0] * 16, 1, "", ""), (5150, [NAN] * 16, 1, "", ""), (5200, [INF] + [0.0] * 15, 1, "", ""),
       (5250, [None] + [1.0] * 15, 1, "", ""), (None, [1.0] * 16, 1, "", ""), (5300, [1.0, 2.0], 1, "", "")]


def test_nearest(make, rows):
    df = make(rows + BAD, SCHEMA)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 50 == 0, k=5, cell_rows=128, query_block=16).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids = np.array([r[0] for r in rows])
    c = cosines(rows)
    hit = total = 0
    queries = sorted({r[0] for r in rows if r[0] % 50 == 0})
    assert sorted(got) == queries
    for q in queries:
        i = int(np.flatnonzero(ids == q)[0])
        best = {}
        for j in np.flatnonzero(ids != q):
            best[ids[j]] = max(best.get(ids[j], -2), c[i, j])
        true = sorted(best, key=lambda x: (-round(best[x], 12), x))[:5]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5] and q not in [m[1] for m in mine]
        for (_, a, s), (_, b, t) in zip(mine, mine[1:]):
            assert s > t or (s == t and a < b)
        for _, v, s in mine:
            assert abs(best[v] - s) < 1e-12
        hit += len(set(true) & {m[1] for m in mine})
        total += 5
    assert hit / total >= 0.9


def test_nearest_small_tables(make):
    assert ann.search(make([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    assert ann.search(make(BAD[:6], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    one = make([(0, [1.0, 0.0], 1, "", ""), (1, [1.0, 1.0], None, "", ""), (50, [2.0, 0.0], 1, "", "")], SCHEMA)
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in ann.search(one, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == [(0, 1, 50, 1.0), (0, 2, 1, 0.707107), (50, 1, 0, 1.0), (50, 2, 1, 0.707107)]


def brute_links(rows, least=0.93):
    ids = sorted({r[0] for r in rows})
    near = {i: set() for i in ids}
    good = [r for r in rows if r[0] is not None and r[2] is not None and usable(r[1])]
    for a in range(len(good)):
        for b in range(a):
            x, y = np.array(good[a][1], np.float32).astype(float), np.array(good[b][1], np.float32).astype(float)
            if good[a][2] == good[b][2] and len(x) == len(y) and good[a][0] != good[b][0] and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                near[good[a][0]].add(good[b][0])
                near[good[b][0]].add(good[a][0])
    comp = {}
    for i in ids:
        if i not in comp:
            todo, seen = [i], {i}
            while todo:
                for y in near[todo.pop()] - seen:
                    seen.add(y)
                    todo.append(y)
            comp |= dict.fromkeys(seen, min(seen))
    return near, comp


def test_near_duplicates(make, rows):
    part = [r for r in rows if r[0] % 3 == 0 or r[0] >= 1000] + [(3000, rows[0][1], None, "", "")]
    bad = [r for r in BAD if r[0] is not None]
    near, comp = brute_links(part + bad)
    got = neardup.near_duplicates(make(part + BAD, SCHEMA), cell_rows=64).collect()
    assert len(got) == len(part) + len(BAD)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (len(near[r.vec_id]), comp[r.vec_id], comp[r.vec_id] == r.vec_id), r


def test_near_duplicates_empty(make):
    assert neardup.near_duplicates(make([], SCHEMA)).count() == 0
    assert neardup.near_duplicates(make(BAD[:5], SCHEMA)).filter("kept").count() == 5


def test_collision_threshold_keeps_recall():
    rng = np.random.default_rng(4)
    lines, bound = 32, math.sqrt(2 - 2 * 0.93)
    count = neardup.collision_threshold(lines, 0.9999)
    u = rng.normal(size=(4000, 32))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.normal(size=(4000, 32))
    w -= (w * u).sum(1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    v = 0.93 * u + math.sqrt(1 - 0.93 ** 2) * w
    a = rng.normal(size=(32, lines))
    hits = (np.abs((u - v) @ a) <= neardup.WINDOW * bound).sum(axis=1)
    assert (hits >= count).mean() >= 0.998
    far = (np.abs((u - np.roll(u, 1, axis=0)) @ a) <= neardup.WINDOW * bound).sum(axis=1)
    assert (far >= count).mean() < 0.01


@pytest.mark.parametrize("recall", [0.99, 0.999, 0.9999])
def test_reach_and_count_keep_recall_together(recall):
    reach, count = neardup.reach_and_count(32, recall)
    p = math.erf(neardup.WINDOW / math.sqrt(2))
    counted = sum(math.comb(32, k) * p ** k * (1 - p) ** (32 - k) for k in range(count, 33))
    assert math.erf(reach / math.sqrt(2)) * counted >= recall


def test_pair_far_apart_on_the_first_projection_is_found(make):
    """Cells of one vector: a pair at cosine 0.931 whose first projections differ by 3.8 distance bounds."""
    lines = np.random.default_rng([11, 32]).normal(size=(32, 33))
    rng, d, bound = np.random.default_rng(3), math.sqrt(2 - 2 * 0.931), math.sqrt(2 - 2 * 0.93)
    first, (_, count) = lines[:, 0], neardup.reach_and_count(32, 0.9999)
    hits = 0
    while hits < count:
        side = rng.normal(size=32)
        side -= side @ first / (first @ first) * first
        along = 3.8 * bound / d / (first @ first) * first
        w = along + side / np.linalg.norm(side) * math.sqrt(1 - along @ along)
        m = rng.normal(size=32)
        m -= m @ w * w
        m /= np.linalg.norm(m)
        u, v = (math.sqrt(1 - d * d / 4) * m + s * d / 2 * w for s in (1, -1))
        hits = (np.abs((u - v) @ lines[:, 1:]) <= 0.99 * neardup.WINDOW * bound).sum()
    assert abs((u - v) @ first) > 3.7 * bound
    got = neardup.near_duplicates(make([(1, u.tolist(), 0, "", ""), (2, v.tolist(), 0, "", "")], SCHEMA), cell_rows=1).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (2, 1, 1)]


def test_hilbert_curve_is_a_walk():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    keys = ann.hilbert_keys(grid, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()
