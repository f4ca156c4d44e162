"""Operator 11 against numpy's eigenvectors and exact integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from wishrank.llm import whitening
from wishrank.llm.queries import op11_whitening

ROWS = "vec_id long, embedding array<float>, label int, component string, vec string, n long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", "v", 1) for i, v in rows], ROWS).repartition(3)


@pytest.mark.parametrize("d", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("kind", ["wide", "repeated", "low rank", "graded"])
def test_eigen(d, kind):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((3 * d, d))
    if kind == "low rank":
        a = a[: max(1, d // 2)]
    v = a.T @ a
    if kind == "graded":
        v = v * np.outer(np.logspace(0, -3, d), np.logspace(0, -3, d))
    if kind == "repeated":
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        v = (q * np.repeat([4.0, 1.0], [d // 2, d - d // 2])) @ q.T
    values, vectors = whitening.eigen(v)
    scale = np.abs(v).max() * d
    assert np.allclose(values, np.linalg.eigvalsh((v + v.T) / 2)[::-1], atol=1e-13 * scale)
    assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-13
    assert np.abs(v @ vectors - vectors * values).max() < 1e-13 * scale


def test_eigen_without_a_splitting_shift():
    for v in (np.eye(4), np.zeros((3, 3)), np.ones((6, 6)), np.array([[0, 1], [1, 0.0]]), np.kron(np.eye(3), [[2, 1], [1, 2.0]]), np.zeros((0, 0))):
        values, vectors = whitening.eigen(np.asarray(v, dtype=float))
        assert np.abs(v @ vectors - vectors * values).max(initial=0.0) < 1e-14
        assert list(values) == sorted(values, reverse=True)


def test_polar_is_the_sign():
    a = np.random.default_rng(1).standard_normal((20, 20))
    a = a + a.T
    e, q = np.linalg.eigh(a)
    assert np.abs(whitening.polar(a) - (q * np.sign(e)) @ q.T).max() < 1e-12


def expected(rows):
    """(x - SHIFT, values, vectors) by numpy."""
    x = np.floor(64 * np.array([v for _, v in rows], dtype=np.float32).astype(float))
    y = x - x.mean(axis=0)
    v = y.T @ y / len(x)
    e, q = np.linalg.eigh(v)
    return x, v, e[::-1], q[:, ::-1]


def test_whitened_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(k, (rng.standard_normal(40) * np.linspace(2, 0.3, 40)).astype(np.float32).tolist()) for k in range(400)]
    rows += [(5, rows[9][1]), (None, rows[3][1])]  # equal ids, repeated rows, a null id
    odd = [(900, None), (901, []), (902, [1.0] * 39), (903, [math.nan] * 40), (904, [math.inf] + [0.0] * 39), (905, [None] + [0.0] * 39), (906, [1e30] * 40)]
    got = whitening.whiten(table(spark, rows + odd)).collect()
    x, v, e, q = expected(rows)
    n, total = len(rows), x.sum(axis=0)
    assert len(got) == 32 * n and {r["n"] for r in got} == {n}
    assert {r["vec_id"] for r in got} == {i for i, _ in rows}
    assert {r["component"] for r in got} == set(range(1, 33))
    assert got[0]["identity_error"] < 1e-12 and len({r["identity_error"] for r in got}) == 1
    for r in got:
        assert math.isclose(r["explained"], e[r["component"] - 1] / np.trace(v), rel_tol=1e-9)
    deviation = ((n * x - total) ** 2).sum(axis=1).astype(int)
    single = {i: k for k, (i, _) in enumerate(rows) if i not in (5,)}
    white = (x - total / n) @ q[:, :32] / np.sqrt(e[:32])
    signs: dict[int, float] = {}
    for r in got:
        if r["vec_id"] in single:
            k, c = single[r["vec_id"]], r["component"]
            assert r["deviation"] == deviation[k]
            sign = signs.setdefault(c, math.copysign(1, r["whitened"] * white[k, c - 1]))
            assert abs(sign * r["whitened"] - white[k, c - 1]) < 1e-8


def test_few_or_equal_rows(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, [math.nan])])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    got = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [5.0, 2.0])])).collect()
    assert sorted(round(abs(r["whitened"]), 6) for r in got) == [0.0, 1.224745, 1.224745]
    assert {r["component"] for r in got} == {1} and all(abs(r["explained"] - 1) < 1e-12 for r in got)


def test_far_from_zero_and_beyond_a_long(spark):
    """Offsets much larger than the spread keep their precision; too large deviations are null."""
    rng = np.random.default_rng(4)
    rows = [(k, (1e4 + rng.integers(-3, 4, 5)).astype(float).tolist()) for k in range(60)]
    got = whitening.whiten(table(spark, rows)).collect()
    assert got[0]["identity_error"] < 1e-9
    assert whitening._deviation(np.array([[2.0**40], [0.0]]), 2, (2**40,)).to_pylist() == [None, None]
    assert whitening._deviation(np.array([[2.0**30], [0.0]]), 2, (2**30,)).to_pylist() == [2**60, 2**60]


def test_query(spark):
    got = op11_whitening(spark, "/root/testdata/sf0.001")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    first = got.first()
    assert first["identity_error"] < 1e-4
    assert got.count() == 32 * first["n"]
