"""Whitening against numpy on whole tables, and the eigen solver against known matrices."""

import math

import numpy as np
import pytest

from ontime.llm import whiten as w

SCHEMA = "vec_id long, embedding array<float>, component int, x string, n long"


def matrix(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [
    [5.0, 4.0, 3.0, 2.0, 1.0], [1.0] * 6, [2.0, 2.0, 2.0, 1.0, 1.0, 0.0], [1e9, 1.0, 1e-3], [0.0] * 4, [3.0], [2.0, 1.0],
    list(1 + 1e-9 * np.arange(20)), list(np.linspace(1, 2, 64)), [7.0, 7.0, 1.0] + [0.0] * 20])
def test_leading_eigenvectors(values):
    m = matrix(values)
    found, vectors = w.leading_eigen(m, 8)
    want = np.sort(np.linalg.eigvalsh(m))[::-1][:8]
    size = max(np.abs(want).max(), 1e-300)
    assert np.allclose(found, want, rtol=1e-12, atol=1e-13 * size)
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-12
    assert np.abs(m @ vectors.T - vectors.T * found).max() <= 1e-12 * size


def test_diagonal_and_split_matrices():
    for m in (np.diag([1.0, 5.0, 3.0, 3.0]), np.kron(np.eye(3), matrix([2.0, 1.0])), np.zeros((2, 2))):
        found, vectors = w.leading_eigen(m, 4)
        assert np.allclose(found, np.sort(np.linalg.eigvalsh(m))[::-1][:4], atol=1e-13)
        assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-12


def run(spark, rows, **more):
    out = w.whiten(spark.createDataFrame([(key, v, 1, "x", 2) for key, v in rows], SCHEMA), **more)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return out.collect()


def brute(rows, width):
    kept = [(key, v) for key, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in kept], object)
    n, total = len(kept), x.sum(0)
    deviation = ((n * x - total) ** 2).sum(1)
    centred = (n * x - total).astype(float) / n
    return [key for key, _ in kept], n, deviation, centred, centred.T @ centred / n


def test_like_numpy(spark):
    draw = np.random.default_rng(1)
    rows = [(n, (draw.normal(0, 0.1, 12) * np.arange(1, 13)).tolist()) for n in range(500)]
    rows += [(600, None), (601, [None] * 12), (602, [float("nan")] * 12), (603, [float("inf")] * 12), (None, [0.5] * 12), (5, [0.25] * 12), (604, [0.5] * 3)]
    keys, n, deviation, centred, v = brute(rows, 12)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    got = run(spark, rows)
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    assert sorted((str(r.vec_id), r.deviation) for r in got if r.component == 1) == sorted((str(k), int(d)) for k, d in zip(keys, deviation))
    want = centred @ vectors / np.sqrt(values)
    for c in range(1, 9):
        mine = sorted((str(r.vec_id), r.deviation, r.whitened) for r in got if r.component == c)
        theirs = sorted((str(k), int(d), x) for k, d, x in zip(keys, deviation, want[:, c - 1]))
        a, b = np.array([m[2] for m in mine]), np.array([t[2] for t in theirs])
        assert np.allclose(a * np.sign(a @ b), b, atol=1e-9)
        assert math.isclose(got[[r.component for r in got].index(c)].explained, values[c - 1] / np.trace(v), rel_tol=1e-9)
    assert got[0].identity_error < 1e-9


def test_constant_single_empty_and_short(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []
    one = run(spark, [(1, [0.5, 0.25])])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 1, 0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0)]
    line = run(spark, [(n, [float(n), float(n)]) for n in range(10)])  # one direction only
    assert {r.whitened for r in line if r.component == 2} == {0.0}
    assert all(r.explained == pytest.approx(1.0) for r in line if r.component == 1)
    assert run(spark, [(1, [])]) == []


def test_deviation_beyond_64_bits_is_null(spark):
    got = run(spark, [(1, [1e7]), (2, [-1e7]), (3, [3e8])])
    keys, n, deviation, *_ = brute([(1, [1e7]), (2, [-1e7]), (3, [3e8])], 1)
    assert {r.vec_id: r.deviation for r in got} == {k: int(d) if d < 2 ** 63 else None for k, d in zip(keys, deviation)}
    run(spark, [(1, [3e38]), (2, [-3e38])])
