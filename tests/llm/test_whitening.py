import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from quireflow.llm.whitening import Whitening, covariance, jacobi, op12_jacobi_whitening, scatter, whiten


@pytest.mark.parametrize("d", [1, 2, 3, 7, 40])
def test_rotations_find_eigenvalues(d):
    r = np.random.default_rng(d)
    a = r.normal(size=(d, d))
    a = a @ a.T
    values, vectors = jacobi(a)
    assert np.all(np.diff(values) <= 0)
    assert np.allclose(vectors.T @ vectors, np.eye(d), atol=1e-13)
    assert np.allclose(a @ vectors, vectors * values, atol=1e-12 * values[0])
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-12 * values[0])


def test_small_eigenvalues_keep_their_digits():
    # a graded matrix D C D: relative accuracy is what Jacobi gives and a reduction to tridiagonal form does not
    r = np.random.default_rng(3)
    d = 8
    c = np.eye(d) + 0.01 * (lambda m: m + m.T)(r.normal(size=(d, d)))
    scale = 10.0 ** -np.arange(0, 2 * d, 2)
    values, _ = jacobi(scale[:, None] * c * scale)
    import fractions

    exact = 1.0
    whole = [[fractions.Fraction(float(scale[i] * c[i, j] * scale[j])) for j in range(d)] for i in range(d)]
    whole = [[whole[min(i, j)][max(i, j)] for j in range(d)] for i in range(d)]
    det = fractions.Fraction(1)
    for i in range(d):
        det *= whole[i][i]
        for k in range(i + 1, d):
            f = whole[k][i] / whole[i][i]
            whole[k] = [x - f * y for x, y in zip(whole[k], whole[i], strict=True)]
    exact = float(det / fractions.Fraction(float(np.prod(values[:4]))) / fractions.Fraction(float(np.prod(values[4:]))))
    assert exact == pytest.approx(1.0, rel=1e-12)


def test_nothing_to_turn():
    values, vectors = jacobi(np.diag([1.0, 3.0, 2.0]))
    assert values.tolist() == [3, 2, 1]
    assert np.array_equal(np.abs(vectors), np.eye(3)[:, [1, 2, 0]])
    assert jacobi(np.zeros((2, 2)))[0].tolist() == [0, 0]


def test_scatter_is_exact_for_large_entries():
    x = np.array([[1 << 40, 3], [-(1 << 41), 5], [7, -(1 << 30)]], dtype=np.int64)
    centre = np.array([11, -2])
    y = [[int(v) - int(c) for v, c in zip(row, centre, strict=True)] for row in x]
    want = [sum(r[0] for r in y), sum(r[1] for r in y), sum(r[0] ** 2 for r in y), sum(r[0] * r[1] for r in y), sum(r[1] ** 2 for r in y)]
    assert scatter(x, centre).tolist() == want
    n = 3
    assert covariance(n, 2, want)[0, 1] == pytest.approx((want[3] - want[0] * want[1] / n) / n, rel=1e-12)


def brute(rows, components=4):
    """Plain numpy over a list of (id, vector)."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, sums = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T, bias=True)
    e, w = np.linalg.eigh(np.atleast_2d(v))
    e, w = e[::-1], w[:, ::-1]
    out = {}
    for i, x in kept:
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
        z = (np.array(x) - sums / n) @ w / np.sqrt(e)
        out.setdefault(i, []).append((deviation, np.abs(z[:components])))
    return n, e / e.sum(), out


def test_query_equals_numpy(spark):
    got = op12_jacobi_whitening(spark, "/root/testdata/sf0.01").collect()
    source = pq.read_table("/root/testdata/sf0.01/embeddings.parquet")
    n, explained, want = brute(list(zip(source["vec_id"].to_pylist(), source["embedding"].to_pylist(), strict=True)))
    assert len(got) == 4 * len(want)
    for r in got:
        deviation, z = want[r.vec_id][0]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(z[r.component - 1], abs=1e-8)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-10)
        assert 0 <= r.identity_error < 1e-10
    # one sign for all rows
    by = {(r.vec_id, r.component): r.whitened for r in got}
    ids = sorted(want)
    x = {i: np.array([math.floor(256 * c) for c in v], float) for i, v in zip(source["vec_id"].to_pylist(), source["embedding"].to_pylist(), strict=True)}
    for component in range(1, 5):
        a = np.array([by[i, component] for i in ids])
        direction = np.linalg.lstsq(np.array([x[i] - np.mean(list(x.values()), axis=0) for i in ids]), a, rcond=None)[0]
        assert np.allclose(np.array([x[i] - np.mean(list(x.values()), axis=0) for i in ids]) @ direction, a, atol=1e-8)


KIND = "vec_id long, embedding array<float>, deviation int, x string"


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    r = np.random.default_rng(1)
    good = [(i, [float(np.float32(v)) for v in r.normal(size=3)]) for i in range(40)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 0.0, 0.0]), (103, [0.0, -inf, 0.0]), (104, [-0.0, 0.0, 0.001]), (104, [-0.0, 0.0, 0.001]), (None, good[3][1])]
    rows = good + odd
    vectors = spark.createDataFrame([(i, v, 1, "y") for i, v in rows], KIND).repartition(3)
    out, fitted = whiten(vectors)
    n, explained, want = brute(rows)
    assert fitted.n == n == 41
    assert fitted.explained == pytest.approx(explained, rel=1e-10)
    assert fitted.identity_error() < 1e-10
    got = {}
    for row in out.collect():
        got.setdefault(row.vec_id, []).append((row.deviation, np.abs(row.whitened)))
    assert got.keys() == want.keys()
    for i, rows_ in want.items():
        assert [d for d, _ in got[i]] == [d for d, _ in rows_]
        assert np.allclose([z for _, z in got[i]], [z[:4] for _, z in rows_], atol=1e-8)


def test_no_rows_and_no_variance(spark):
    assert whiten(spark.createDataFrame([], KIND))[0].collect() == []
    same = spark.createDataFrame([(i, [0.5, 0.25], 0, "") for i in range(3)], KIND)
    out, fitted = whiten(same)
    assert [r.whitened for r in out.collect()] == [[], [], []] and fitted.n == 1
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], 0, "") for i in range(5)], KIND)
    out, fitted = whiten(flat)
    assert fitted.matrix.shape == (3, 1) and fitted.explained == pytest.approx([1.0])
    assert np.var([r.whitened[0] for r in out.collect()]) == pytest.approx(1.0)


def test_unequal_lengths_are_an_error(spark):
    with pytest.raises(ValueError, match="2 to 3"):
        Whitening(spark.createDataFrame([([1, 2],), ([1, 2, 3],)], "x array<long>"))
