"""Whitening against plain formulas in exact arithmetic and numpy's own eigenvectors."""

import math
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF001

from tastespark.io import table
from tastespark.llm import whitening as w
from tastespark.llm.queries import op12_whitening


def plain(rows, most=16):
    """Expected rows by the definition: exact covariance, numpy's eigenvectors."""
    good = [(i, tuple(math.floor(64 * float(c)) + 1000000 for c in v)) for i, v in rows
            if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in good})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    y = np.array([[x[j] * n - s[j] for j in range(d)] for x in fit], dtype=object)
    v = np.array([[float(Fraction(int(t), n ** 3)) for t in line] for line in y.T @ y])
    e, q = np.linalg.eigh(v)
    return good, n, s, v, e[::-1][:most], q[:, ::-1][:, :most]


def compare(got, rows, most=16):
    good, n, s, v, e, q = plain(rows, most)
    k = int((e > 1e-12 * e[0]).sum())
    assert len(got) == len(good) * k
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    for j in range(1, k + 1):
        order = lambda r: (str(r[0]), str(r[1]))
        mine = sorted(((r.vec_id, r.deviation, r.whitened) for r in by[j]), key=order)
        want = sorted(((i, sum((n * x[t] - s[t]) ** 2 for t in range(len(s))),
                        float(np.dot([float(Fraction(n * x[t] - s[t], n)) for t in range(len(s))], q[:, j - 1]) / math.sqrt(e[j - 1])))
                       for i, x in good), key=order)
        assert [m[:2] for m in mine] == [m[:2] for m in want]
        a, b = np.array([m[2] for m in mine]), np.array([m[2] for m in want])
        # rows of equal id and deviation may stand in either order
        assert min(np.abs(np.sort(a) - np.sort(b)).max(), np.abs(np.sort(a) + np.sort(b)[::-1]).max()) < 1e-6 * np.abs(b).max()
        assert all(r.n == n and abs(r.explained - e[j - 1] / np.trace(v)) <= 1e-9 * r.explained for r in by[j])
    assert len({r.identity_error for r in got}) <= 1 and all(r.identity_error < 1e-8 for r in got)


@pytest.mark.parametrize("kind", ["random", "graded", "repeated", "clusters", "low rank", "diagonal", "negative"])
def test_divide_and_conquer(kind):
    rng = np.random.default_rng(3)
    d = 40
    basis = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {"random": rng.random(d), "graded": 10.0 ** -np.arange(0, 10, 0.25), "repeated": np.repeat([3.0, 2.0, 1.0, 0.5], 10),
              "clusters": np.repeat([5.0, 1.0], 20) + 1e-9 * rng.random(d), "low rank": np.r_[rng.random(5), np.zeros(35)],
              "diagonal": np.arange(40.0), "negative": rng.standard_normal(d)}[kind]
    a = np.diag(values) if kind == "diagonal" else basis * values @ basis.T
    a = (a + a.T) / 2
    e, q = w.spectral_components(a)
    scale = np.abs(values).max()
    assert np.abs(q.T @ q - np.eye(d)).max() < 1e-13 and np.abs(a @ q - q * e).max() < 2e-14 * scale * d
    assert np.abs(e - np.sort(values)[::-1]).max() < 1e-13 * scale and (np.diff(e) <= 0).all()
    want = np.linalg.eigh(a)[1][:, ::-1]
    gaps = np.abs(np.subtract.outer(e, e) + np.diag(np.full(d, np.inf))).min(axis=1)
    clear = gaps > 1e-3 * scale
    assert np.abs(np.abs((q * want).sum(axis=0)[clear]) - 1).max(initial=0) < 1e-12


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(5)
    basis = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    values = np.array([1, -1, 1e-12, -1e-9, 3, 4, -5, 0.1, -0.2, 1e-3, 2, -7.0])
    u = w.polar_factor(basis * values @ basis.T)
    assert np.abs(u - basis * np.sign(values) @ basis.T).max() < 1e-3
    assert np.abs(u @ u - np.eye(12)).max() < 1e-13


def test_small_table_with_odd_rows(make):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rng.standard_normal(5)]) for i in range(60)]
    rows += [(60, rows[0][1]), (60, rows[0][1]), (None, rows[1][1]), (61, None), (62, []), (63, [1.0, None, 0.0, 0.0, 0.0]),
             (64, [float("nan")] * 5), (65, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (66, [0.0] * 5), (67, rows[0][1])]
    emb = make([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, n int, x string")
    compare(w.whiten(emb).collect(), rows)
    other = make([(i, v) for i, v in rows] + [(99, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert 99 not in {r.vec_id for r in w.whiten(other).collect()}


def test_large_values_stay_exact(make):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in 1e7 + 3e5 * rng.standard_normal(3)]) for i in range(40)]
    compare(w.whiten(make(rows, "vec_id long, embedding array<double>")).collect(), rows)
    huge = make([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    got = w.whiten(huge).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and {r.deviation for r in got if r.vec_id == 1} == {None}


def test_one_constant_dimension_and_few_vectors(make):
    rows = [(i, [1.0, float(i), 2.0 * i]) for i in range(10)]
    compare(w.whiten(make(rows, "vec_id long, embedding array<double>")).collect(), rows)
    assert w.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect() == []
    empty = w.whiten(make([], "vec_id long, embedding array<float>"))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_registered_query(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF001, "embeddings").select("vec_id", "embedding").collect()]
    compare(op12_whitening(spark, SF001).collect(), rows)
