"""Whitening against the full eigenproblem."""

import numpy as np
import pytest

from rosterline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def slow(vectors):
    """Fit list size, sums, eigenvalues and eigenvectors of whole vectors, by the full matrix."""
    x = np.array([[int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v] for v in vectors], np.int64)
    fit = np.unique(x, axis=0)
    mean = fit.mean(axis=0)
    values, turn = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    return x, fit, values[::-1], turn[:, ::-1]


def run(spark, rows, schema=SCHEMA):
    vectors = whitening.whole_vectors(spark.createDataFrame(rows, schema))
    return whitening.whiten(vectors, whitening.fit_whitening(vectors)).toPandas()


@pytest.mark.parametrize("count, size", [(300, 5), (200, 64), (40, 100)])
def test_equals_the_full_eigenproblem(spark, count, size):
    draw = np.random.default_rng(size)
    data = (draw.normal(size=(count, size)) * np.linspace(1, 4, size)).astype(np.float32)
    found = run(spark, [(k, v.tolist()) for k, v in enumerate(data)])
    x, fit, values, turn = slow(data)
    width = min(16, size)
    assert len(found) == count * width and set(found.n) == {len(fit)}
    mine = found.sort_values(["vec_id", "component"]).whitened.to_numpy().reshape(count, width)
    wanted = (x - fit.mean(axis=0)) @ turn[:, :width] / np.sqrt(values[:width])
    signs = np.sign((mine * wanted).sum(axis=0))
    assert np.abs(mine * signs - wanted).max() < 1e-7
    assert np.allclose(found.sort_values(["vec_id", "component"]).explained[:width], values[:width] / values.sum(), rtol=1e-10)
    assert found.identity_error.max() < 1e-10
    sums = [int(s) for s in fit.sum(axis=0)]
    deviation = [sum((len(fit) * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert found.sort_values(["vec_id", "component"]).deviation.to_numpy().reshape(count, width)[:, 0].tolist() == deviation


def test_eigenpairs_by_products_alone():
    draw = np.random.default_rng(2)
    turn = np.linalg.qr(draw.normal(size=(400, 400)))[0]
    values = np.concatenate([[9, 9, 9 * (1 - 1e-9), 5, 5], np.linspace(4, 0.5, 395)])
    matrix = (turn * values) @ turn.T
    found = whitening.largest_eigenpairs(lambda block: matrix @ block, 400, 16)
    assert np.abs(found.values - np.sort(values)[::-1][:16]).max() < 1e-12
    assert np.abs(matrix @ found.vectors - found.vectors * found.values).max() < 1e-12
    assert np.abs(found.vectors.T @ found.vectors - np.eye(16)).max() < 1e-13
    assert found.products < 400  # block products; the search space never holds the whole matrix


def test_corrections_solve_the_projected_equation():
    draw = np.random.default_rng(4)
    half = draw.normal(size=(30, 30))
    matrix = half @ half.T
    ritz = np.linalg.qr(draw.normal(size=(30, 2)))[0]
    theta = (ritz * (matrix @ ritz)).sum(axis=0)
    residual = matrix @ ritz - theta * ritz
    found = whitening._corrections(lambda b: matrix @ b, theta, ritz, residual, np.zeros((30, 0)), 40)
    for k in range(2):
        off = np.eye(30) - np.outer(ritz[:, k], ritz[:, k])
        assert np.abs(off @ (matrix - theta[k] * np.eye(30)) @ off @ found[:, k] + off @ residual[:, k]).max() < 1e-6
        assert abs(ritz[:, k] @ found[:, k]) < 1e-10


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (None, [0.0, 1.0, 3.0]), (3, [4.0, -1.0, 0.25]), (4, [2.0, 2.0, 2.0])]
    odd = [(5, None), (6, [1.0, None, 2.0]), (7, [nan, 1.0, 1.0]), (8, [inf, 1.0, 1.0]), (9, []), (10, [1.0, 2.0])]
    schema = "vec_id long, embedding array<float>, x string, n string, component int"
    found = run(spark, [(*r, "a", "b", 1) for r in rows + odd], schema)
    assert set(found.n) == {4} and len(found) == 5 * 3
    assert sorted(found.vec_id.fillna(-1).unique()) == [-1, 1, 3, 4]
    assert found.identity_error.max() < 1e-10


def test_lists_without_variance_or_rows(spark):
    same = [(k, [1.0, 2.0]) for k in range(5)]
    assert len(run(spark, same)) == 0 and len(run(spark, [])) == 0 and len(run(spark, [(1, None)])) == 0
    line = run(spark, [(k, [float(k), 2.0 * k, 7.0]) for k in range(9)])
    assert len(line) == 9 and line.explained.iloc[0] == pytest.approx(1, rel=1e-12)


def test_large_entries(spark):
    rows = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 3.0])]
    found = run(spark, rows)
    assert len(found[found.component == 1]) == 3 and found.deviation.isna().sum() > 0 and np.isfinite(found.whitened).all()


def test_hot_vector_counts_once(spark):
    draw = np.random.default_rng(5)
    some = [(k, draw.normal(size=4).tolist()) for k in range(30)]
    one = run(spark, some)
    many = run(spark, some + [(100 + k, some[0][1]) for k in range(3000)])
    assert set(many.n) == {30} and len(many) == 3030 * 4
    assert np.allclose(sorted(one.explained.unique()), sorted(many.explained.unique()), rtol=1e-12)
