"""Whitening against floating-point and rational linear algebra."""

from fractions import Fraction

import numpy as np
import pytest

from phenoscope.llm import whitening as W


def table(spark, vectors):
    rows = [(i, v, "x", 1.0, 2) for i, v in vectors]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, _id string, whitened double, n int")


def run(spark, vectors, components=32):
    out = W.whiten(table(spark, vectors).repartition(3), components)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return out.toPandas().sort_values(["vec_id", "component"])


def expected(vectors):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)) + 1_000_000
    z = x - x.mean(axis=0)
    e, v = np.linalg.eigh(z.T @ z / len(x))
    return x, z, e[::-1], v[:, ::-1]


def test_like_floating_point(spark):
    rnd = np.random.default_rng(1)
    data = rnd.normal(size=(300, 12)) * np.linspace(3, 0.2, 12)
    out = run(spark, [(i, row.tolist()) for i, row in enumerate(data)], 8)
    x, z, e, v = expected(data)
    w = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert w.shape == (300, 8) and set(out.n) == {300}
    want = (z @ v / np.sqrt(e))[:, :8]
    assert np.abs(w - want * np.sign((w * want).sum(axis=0))).max() < 1e-9
    assert np.allclose(out.groupby("component").explained.first(), e[:8] / e.sum(), rtol=1e-12)
    deviation = ((300 * x.astype(int) - x.astype(int).sum(axis=0)) ** 2).sum(axis=1)
    assert out.groupby("vec_id").deviation.first().astype(int).tolist() == deviation.tolist()
    cov = np.cov(w.T, bias=True)
    assert out.identity_error.nunique() == 1 and out.identity_error.iloc[0] == pytest.approx(np.abs(cov - np.eye(8)).max(), abs=1e-12)


def test_left_out_rows_repeats_and_null_ids(spark):
    rnd = np.random.default_rng(2)
    good = [(i, r.tolist()) for i, r in enumerate(rnd.normal(size=(40, 3)))] + [(0, [1.0, 2.0, 3.0]), (None, [3.0, 2.0, 1.0])]
    bad = [(50, None), (51, []), (52, [1.0, None, 1.0]), (53, [1.0, float("nan"), 2.0]), (54, [float("inf"), 0.0, 1.0]),
           (55, [1.0, 2.0]), (56, [1.0, 2.0, 3.0, 4.0]), (57, [1e30, 0.0, 0.0])]
    out = run(spark, good + bad)
    assert len(out) == 3 * 42 and set(out.n) == {42} and out.vec_id.isna().sum() == 3
    assert not set(out.vec_id.dropna()) & set(range(50, 60))


def test_equal_eigenvalues_and_missing_variance(spark):
    corners = [(a, b, 0.5) for a in (-1.0, 1.0) for b in (-1.0, 1.0)]
    out = run(spark, [(i, list(c)) for i, c in enumerate(corners)])
    assert set(out.component) == {1, 2} and np.allclose(out.explained, 0.5) and out.identity_error.max() < 1e-12
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert len(run(spark, rows)) == 0


def test_reruns_agree(spark):
    vectors = [(i, r.tolist()) for i, r in enumerate(np.random.default_rng(3).normal(size=(90, 5)))]
    assert run(spark, vectors).equals(run(spark, vectors))


def test_large_entries_are_exact(spark):
    """Sums of products over 2^53 and 2^63, and deviations over 64 bits."""
    rnd = np.random.default_rng(4)
    data = [[float(v) * 2.0 ** 40 for v in row] for row in rnd.integers(-1000, 1000, size=(20, 3))]
    out = run(spark, list(enumerate(data)))
    y = [[int(64 * v) for v in row] for row in data]
    sums = [sum(c) for c in zip(*y)]
    want = [sum((20 * v - s) ** 2 for v, s in zip(row, sums)) for row in y]
    assert [int(v) for v in out.groupby("vec_id").deviation.first()] == want and out.identity_error.iloc[0] < 1e-9


def leverrier(matrix):
    """Elementary symmetric sums of the eigenvalues in rational arithmetic."""
    d, m, out = len(matrix), [[Fraction(0)] * len(matrix) for _ in matrix], [Fraction(1)]
    c = Fraction(1)
    for k in range(1, d + 1):
        m = [[sum(matrix[i][t] * m[t][j] for t in range(d)) + (c if i == j else 0) for j in range(d)] for i in range(d)]
        c = -sum(sum(matrix[i][t] * m[t][i] for t in range(d)) for i in range(d)) / k
        out.append(c * (-1) ** k)
    return [int(v) for v in out]


@pytest.mark.parametrize("rank", [7, 4, 1])
def test_polynomial_is_exact(spark, rank):
    a = np.random.default_rng(rank).integers(-10**6, 10**6, size=(7, rank)).astype(object)
    matrix = (a @ a.T).tolist()
    sums = W.elementary(spark, matrix)
    assert sums == leverrier(matrix) and sums[1] == sum(matrix[i][i] for i in range(7)) and not any(sums[rank + 1:])


def test_polynomial_needs_row_swaps():
    matrix = [[0, 0, 1, 2], [0, 3, 0, 1], [1, 0, 5, 0], [2, 1, 0, 7]]
    want = np.poly(np.array(matrix, float)).round().astype(int).tolist()
    p = W.primes(10)[0]
    assert [v - p if v > p // 2 else v for v in W.polynomial_mod(matrix, p)] == want


def test_roots_are_counted_and_found():
    # (x - 1)^2 (x - 4)(x - 9)(x - 1/3): elementary sums times 3 are not needed, so take integers
    sums, values = [1], [1, 1, 4, 9]
    for v in values:
        sums = [a + v * b for a, b in zip([*sums, 0], [0, *sums])]
    poly = [(-e if k % 2 else e) for k, e in enumerate(sums)]
    assert [W.roots_above(poly, at) for at in (0, 1, 3, 4, 8, 9)] == [4, 2, 2, 1, 1, 0]
    assert W.largest_roots(sums, 3) == [9, 4, 1] and W.largest_roots(sums + [0, 0], 9) == [9, 4, 1, 1]


def test_primes():
    found = W.primes(1 << 200)
    assert found[0] == 2**31 - 1 and len(found) == 7 and all(p % q for p in found for q in range(2, 2000))
