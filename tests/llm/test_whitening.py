"""Eigenvectors and whitened rows against the dense covariance matrix; odd vectors; many dimensions."""

import numpy as np
import pytest

from llm.whitening import fit, leading, minres, whitened

SCHEMA = "vec_id long, embedding array<float>"


def dense(rows, wanted):
    x = np.floor(64 * np.array(rows, np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    c = (x * n - total) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1][:, :wanted]
    return c @ u / np.sqrt(e[:wanted]), e[:wanted] / e.sum(), ((x * n - total) ** 2).sum(axis=1)


def vectors(n, dim, seed):
    r = np.random.default_rng(seed)
    return (r.standard_normal((n, dim)) * np.linspace(3, 1, dim)).astype(np.float32)


def test_against_the_dense_matrix(spark):
    x = vectors(700, 40, 1)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    odd = [(1000, None), (1001, [None] + [0.5] * 39), (1002, [float("nan")] * 40), (1003, [float("inf")] + [0.0] * 39), (1004, []), (1005, [1.0, 2.0])]
    table = spark.createDataFrame(rows + odd + [(3, x[3].tolist()), (None, x[5].tolist())], SCHEMA).selectExpr("*", "'a' AS n", "0 AS part", "1 AS component")
    got = whitened(table).toPandas()
    expected, share, deviation = dense([*x, x[3], x[5]], 32)
    assert len(got) == 702 * 32 and set(got.n) == {702}
    assert sorted(got.vec_id.dropna().astype(int).unique()) == list(range(700)) and got.vec_id.isna().sum() == 32
    once = got[got.vec_id.notna() & (got.vec_id != 3)]
    z = once.pivot(index="vec_id", columns="component", values="whitened")
    plain = expected[z.index.astype(int)]
    sign = np.sign((z.to_numpy() * plain).sum(axis=0))
    assert np.abs(z.to_numpy() * sign - plain).max() < 1e-9
    assert np.allclose(got.groupby("component").explained.first(), share, rtol=1e-12)
    assert dict(zip(once.vec_id.astype(int), once.deviation, strict=True)) == {k: int(deviation[k]) for k in z.index.astype(int)}
    assert got.identity_error.max() < 1e-10 and got.identity_error.nunique() == 1


def test_nothing_and_nothing_that_varies(spark):
    assert whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitened(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).collect() == []
    assert whitened(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)).collect() == []
    flat = fit(spark.createDataFrame([(k, [1.0, float(k)]) for k in range(5)], SCHEMA))
    assert len(flat.values) == 1 and abs(flat.vectors[1, 0]) == pytest.approx(1)


def test_deviations_beyond_a_long_are_null(spark):
    got = whitened(spark.createDataFrame([(k, [1e9 * k, 1.0]) for k in range(3)], SCHEMA)).collect()
    assert [r.deviation for r in sorted(got, key=lambda r: r.vec_id)][0] is None


@pytest.mark.parametrize("shape", ["even", "close", "steep"])
def test_many_more_dimensions_than_components(shape):
    r = np.random.default_rng(8)
    dim, wanted, calls = 600, 32, []
    values = {"even": np.linspace(10, 0.1, dim), "close": 1 + np.linspace(1, 0, dim) ** 3, "steep": 10.0 ** -np.linspace(0, 9, dim)}[shape]
    turn = np.linalg.qr(r.standard_normal((dim, dim)))[0]
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2

    def product(block):
        calls.append(block.shape[1])
        return matrix @ block

    found, directions, far = leading(product, dim, wanted)
    assert np.allclose(found, np.sort(values)[::-1][:wanted], rtol=1e-10)
    assert np.linalg.norm(matrix @ directions - found * directions, axis=0).max() <= 1e-12 * found[0] and far <= 1e-12 * found[0]
    assert max(calls) <= 40 and np.abs(directions.T @ directions - np.eye(wanted)).max() < 1e-12


def test_minres_solves_a_shifted_system_outside_a_basis():
    r = np.random.default_rng(4)
    q = np.linalg.qr(r.standard_normal((30, 30)))[0]
    matrix, basis = (q * np.arange(30, 0, -1)) @ q.T, q[:, :3]
    right = r.standard_normal((30, 2))
    shift = np.array([30.5, 2.5])
    z = minres(lambda b: matrix @ b, shift, basis, right, 60)
    rest = matrix @ z - shift * z - right
    assert np.abs(rest - basis @ (basis.T @ rest)).max() < 1e-8 and np.abs(basis.T @ z).max() < 1e-12
