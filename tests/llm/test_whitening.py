import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.llm import whitening
from fraudlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(vectors):
    """{component: (whitened, explained)} and n, deviations by numpy's eigh."""
    x = np.floor(256 * np.array(vectors, float)).astype(np.int64) + 0
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    y = fit - s / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1], v[:, ::-1]
    w = (x - s / n) @ v[:, :4] / np.sqrt(e[:4])
    return n, [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for r in x], w, e / e.sum()


def test_query_equals_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    got = {(r.vec_id, r.component): r for r in QUERIES["op11_whitening"](spark, SF).collect()}
    n, dev, w, share = brute([r.embedding for r in rows])
    assert len(got) == 4 * len(rows)
    for c in range(4):
        own = np.array([got[r.vec_id, c + 1].whitened for r in rows])
        sign = np.sign(own @ w[:, c])
        np.testing.assert_allclose(own * sign, w[:, c], atol=1e-9)
        for k, r in enumerate(rows):
            g = got[r.vec_id, c + 1]
            assert (g.n, g.deviation) == (n, dev[k])
            assert abs(g.explained / share[c] - 1) < 1e-9
            assert g.identity_error < 1e-9


@pytest.mark.parametrize("d,rank", [(1, 1), (2, 2), (7, 7), (24, 24), (9, 4), (6, 1)])
def test_eigen_equals_numpy(d, rank):
    rng = np.random.default_rng(d * 31 + rank)
    b = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-3, 4, rank)
    a = b @ b.T
    values, vectors = whitening.eigen(a)
    want = np.sort(np.linalg.eigvalsh(a))[::-1]
    assert len(values) >= 1
    np.testing.assert_allclose(values, want[:len(values)], rtol=1e-6, atol=1e-12 * want[0])
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-9)
    np.testing.assert_allclose((vectors * values) @ vectors.T, a, atol=1e-9 * want[0])


def test_equal_eigenvalues_and_the_zero_matrix():
    values, vectors = whitening.eigen(np.diag([3.0, 5.0, 5.0, 0.0]))
    np.testing.assert_allclose(values, [5, 5, 3])
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(3), atol=1e-15)
    assert len(whitening.eigen(np.zeros((3, 3)))[0]) == 0


def test_pivoted_cholesky_orders_by_what_is_left():
    a = np.array([[1.0, 0.5, 0.1], [0.5, 4.0, 0.3], [0.1, 0.3, 9.0]])
    lower, order = whitening.pivoted_cholesky(a)
    assert order[0] == 2 and np.allclose(np.triu(lower, 1), 0)
    np.testing.assert_allclose(lower @ lower.T, a[np.ix_(order, order)])


HARD = [(1, [0.5, -0.25, 0.1]), (1, [0.5, -0.25, 0.1]), (2, [0.0, 0.0, 0.0]), (3, None), (4, []),
        (5, [1.0, None, 2.0]), (6, [float("nan"), 0.0, 0.0]), (7, [float("inf"), 0.0, 0.0]),
        (None, [0.1, 0.2, 0.3]), (8, [-1.0, 2.0, 0.7]), (9, [1e300, 0.0, 0.0]), (10, [1.0, 2.0])]


def test_hard_rows(spark):
    df = spark.createDataFrame(HARD, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("extra") for c in ("x", "v", "n", "component", "d")})
    got = whitening.whiten(df).collect()
    kept = [v for i, v in HARD if i in (1, 2, None, 8)]
    n, dev, w, _ = brute(kept)
    assert n == 4
    by_id = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.component), []).append(r)
    assert sorted({r.vec_id for r in got}, key=str) == [1, 2, 8, None]
    assert len(by_id[1, 1]) == 2 and len(got) == 5 * 3
    assert by_id[8, 1][0].deviation == dev[-1]
    assert got[0].identity_error < 1e-9


def test_no_variance_and_no_rows(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)
    assert whitening.whiten(same).count() == 0


def test_large_counts_stay_exact():
    model = whitening.Whitening(3_000_000_019, [10 ** 15, -7], np.eye(2), np.ones(2), 2.0)
    got = model.deviations(np.array([[333, 5]], np.int64))
    assert got == [(3_000_000_019 * 333 - 10 ** 15) ** 2 + (3_000_000_019 * 5 + 7) ** 2]
