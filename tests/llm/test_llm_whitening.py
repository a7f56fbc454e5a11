"""Whitening against dense linear algebra."""

import math
import random

import numpy as np
import pytest

from corate.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def plain(rows, count=4):
    """{(row number, component)}: n, deviation, |whitened|, explained."""
    keep = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max((len(v) for _, v in keep), default=0)
    xs = [[math.floor(256 * float(np.float32(c))) for c in v] + [0] * (dim - len(v)) for _, v in keep]
    fit = sorted(set(map(tuple, xs)))
    n = len(fit)
    if n < 2:
        return []
    sums = [sum(c) for c in zip(*fit, strict=True)]
    mean = np.array(sums) / n
    centred = np.array(fit) - mean
    cov = centred.T @ centred / n
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1][:count], vec[:, ::-1][:, :count]
    ok = e > 1e-11 * e[0]
    e, vec = e[ok], vec[:, ok]
    out = []
    for (i, _), x in zip(keep, xs, strict=True):
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        y = (np.array(x) - mean) @ vec / np.sqrt(e)
        out += [(i, c + 1, n, deviation, abs(y[c]), e[c] / np.trace(cov)) for c in range(len(e))]
    return out


def check(df, rows, tol=1e-9, count=4):
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3])
    found = df.collect()
    got = sorted([(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in found], key=order)
    want = sorted(plain(rows, count), key=order)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[4:] == pytest.approx(w[4:], rel=tol, abs=tol)
    assert all(r.identity_error < 1e-8 for r in found)
    return found


def test_whitening_matches_dense_algebra(spark):
    rng = np.random.default_rng(5)
    scale = 1.2 ** -np.arange(20)
    rows = [(i, (rng.standard_normal(20) * scale).tolist()) for i in range(600)]
    rows += [(700 + i, rows[3][1]) for i in range(400)]  # a large group of equal vectors
    found = check(whitening.whitened(frame(spark, rows).repartition(5)), rows)
    top = max(r.eigenvalue for r in found)
    assert max(r.residual for r in found) < 1e-14 * top


def test_partial_sums_are_added_by_a_shuffle_beyond_a_bound(spark, monkeypatch):
    monkeypatch.setattr(whitening, "DIRECT_PARTIALS", 0)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, k + 1) for k in range(6)]) for i in range(60)]
    check(whitening.whitened(frame(spark, rows)), rows)


@pytest.mark.parametrize("rows", [
    [], [(1, None)], [(1, [])], [(1, [0.5, 0.25])], [(1, [0.5]), (1, [0.5]), (2, [0.75])],
    [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0])],
    [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (4, [0.5, -1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
     (7, [None, 1.0]), (8, None), (9, [3.0]), (10, []), (11, [0.1, 0.2, -0.3]), (12, [-0.0, -1e-9, 1.0]), (13, [1.0] * 3)],
    [(1, [1e6, 0.0, 1.0]), (2, [-1e6, 3.0, 1.0]), (3, [0.0, 1e5, 2.0]), (4, [1.0, 1.0, 1.0])],
])
def test_odd_rows(spark, rows):
    check(whitening.whitened(frame(spark, rows)), rows, 1e-7)
    wide = frame(spark, rows).selectExpr("*", "1 AS x", "2 AS id", "3 AS n", "4 AS component", "5 AS whitened")
    assert whitening.whitened(wide).count() == whitening.whitened(frame(spark, rows)).count()


def test_entries_beyond_the_long_range(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert got and all(r.n == 3 for r in got) and any(r.deviation is None for r in got)


@pytest.mark.parametrize("dim, count", [(1, 4), (3, 4), (120, 4), (400, 4), (60, 2)])
def test_jacobi_davidson_on_given_matrices(dim, count):
    rng = np.random.default_rng(dim)
    q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    spectrum = np.sort(1 + rng.random(dim))[::-1] * 1000
    if dim == 60:
        spectrum[:3] = 5000.0  # equal leading eigenvalues
    matrix = (q * spectrum) @ q.T
    matrix = (matrix + matrix.T) / 2
    products = []

    def times(columns):
        products.append(columns.shape[1])
        assert columns.shape[1] <= max(48, 12 * count)
        return matrix @ columns

    values, vectors, norms = whitening.leading_eigenvectors(times, dim, count)
    assert values == pytest.approx(spectrum[:min(count, dim)], rel=1e-12)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-13 * spectrum[0] * math.sqrt(dim)
    assert len(products) < 300
