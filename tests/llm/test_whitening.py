"""Whitening against a dense eigensolver, and the qd solver on hard matrices."""

from __future__ import annotations

import math

import numpy as np
import pytest
from llm.conftest import SMALL
from tenura.llm import whitening
from tenura.llm.common import table
from tenura.llm.queries import op11_whiten_embeddings

VECTORS = "vec_id long, embedding array<float>, label int"


def solved(r, most):
    values, vectors = whitening.right_vectors(r, most)
    exact = np.linalg.svd(r, compute_uv=False)[: len(values)] ** 2
    assert np.allclose(values, exact, rtol=1e-11, atol=0)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-9
    c = r.T @ r
    assert np.abs(c @ vectors - vectors * values).max() < 1e-12 * values.max()
    return values


@pytest.mark.parametrize("d", [1, 2, 3, 17, 64])
def test_solver_on_triangles(d):
    rng = np.random.default_rng(d)
    assert len(solved(np.linalg.qr(rng.normal(size=(400, d)), mode="r"), d)) == d


def test_solver_on_hard_spectra():
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    solved(np.linalg.qr(np.diag([5.0] * 6 + [1.0] * 24) @ turn, mode="r"), 30)
    solved(np.linalg.qr(np.diag([5.0 + 1e-13 * i for i in range(6)] + [1.0] * 24) @ turn, mode="r"), 30)
    low_rank = rng.normal(size=(100, 10)) @ rng.normal(size=(10, 30))
    assert len(solved(np.linalg.qr(low_rank, mode="r"), 30)) == 10
    glued = np.diag(np.abs(np.arange(21) - 10.0) + 12) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    solved(np.linalg.cholesky(glued).T, 21)


def test_small_singular_values_are_relatively_exact():
    scales = 10.0 ** -np.arange(14)
    b = np.diag(scales) + np.diag(scales[1:], 1)
    found = whitening.dqds(np.diag(b) ** 2, np.diag(b, 1) ** 2)
    assert math.isclose(math.prod(found), float(np.prod(scales**2)), rel_tol=1e-12)  # the determinant


def test_query_equals_dense_solution(spark):
    rows = table(spark, SMALL, "embeddings").orderBy("vec_id").collect()
    x = np.floor(1024 * np.array([r.embedding for r in rows], np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    exact = centred @ vectors / np.sqrt(values)
    found = op11_whiten_embeddings(spark, SMALL).toPandas().sort_values(["vec_id", "component"])
    assert len(found) == 8 * n and (found.n == n).all()
    got = found.whitened.to_numpy().reshape(n, 8)
    assert np.abs(got * np.sign((got * exact).sum(axis=0)) - exact).max() < 1e-9
    assert np.allclose(found.explained.to_numpy()[:8], values / (centred**2).sum() * n, rtol=1e-9)
    assert (found.deviation.to_numpy()[::8] == ((n * x - s) ** 2).sum(axis=1)).all()
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9


def test_hard_vectors(spark):
    rows = [
        (1, [1.0, 2.0, 4.0], 0), (1, [1.0, 2.0, 4.0], 0), (None, [0.5, -1.0, 4.0], None), (3, None, 1),
        (4, [1.0, None, 2.0], 1), (5, [1.0, math.nan, 2.0], 1), (6, [math.inf, 0.0, 2.0], 1), (7, [], 1),
        (8, [9.0, 9.0], 1), (9, [3.0, 0.25, 4.0], 2),
    ]
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS vector", "2 AS n", "3 AS `a.b`")
    found = whitening.whitened(frame.repartition(1)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in found) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (9, 1), (9, 2)]
    assert {r.n for r in found} == {4} and max(r.identity_error for r in found) < 1e-9
    assert {r.vec_id for r in found} == {None, 1, 9}


def test_no_variance_and_no_rows(spark):
    assert whitening.whitened(spark.createDataFrame([], VECTORS)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None, 0)], VECTORS)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0], 0)] * 3, VECTORS)).collect() == []


def test_deviation_beyond_a_long(spark):
    far = [(i, [float(2**30 * (-1) ** i), float(i)], 0) for i in range(4)]
    found = whitening.whitened(spark.createDataFrame(far, "vec_id long, embedding array<double>, label int")).collect()
    x = [[2**40 * (-1) ** i + 100_000, 1024 * i + 100_000] for i in range(4)]
    s = [sum(c) for c in zip(*x, strict=True)]
    exact = {i: sum((4 * a - b) ** 2 for a, b in zip(v, s, strict=True)) for i, v in enumerate(x)}
    assert all(r.deviation is None and int(r.deviation_exact) == exact[r.vec_id] for r in found)


def test_triangles_of_many_tasks_are_reduced_in_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    frame = table(spark, SMALL, "embeddings").repartition(7, "vec_id")
    found = whitening.whitened(frame).first()
    assert found.n == 500 and found.identity_error < 1e-9
