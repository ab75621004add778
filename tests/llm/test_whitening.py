import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tastegraph.llm import whitening
from tastegraph.llm.queries import op12_whitening

SCHEMA = "vec_id long, embedding array<float>, id long, n int, component double, `a.b` int, x string"


def make(spark, rows):
    return spark.createDataFrame([(i, e, 1, 2, 3.0, 4, "x") for i, e in rows], SCHEMA).repartition(3)


def check(rows, got, k):
    """Against NumPy's eigenvectors of the covariance in full, and whole numbers in Python."""
    x = [(i, [math.floor(64 * v) + 1_000_000 for v in e]) for i, e in rows]
    n, d = len(x), len(x[0][1])
    sums = [sum(e[j] for _, e in x) for j in range(d)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(e, sums)] for _, e in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    real = values > 1e-12 * values.sum()
    count = int(real.sum())
    assert len(got) == n * count
    want = Counter((i, sum((n * a - s) ** 2 for a, s in zip(e, sums))) for i, e in x)
    assert Counter((r.vec_id, int(r.deviation)) for r in got if r.component == 1) == want
    assert {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    trace = (centred**2).sum() / n
    for c in range(count):
        mine = {}
        for r in got:
            if r.component == c + 1:
                mine.setdefault(r.vec_id, []).append(r.whitened)
                assert abs(r.explained - values[c] / trace) < 1e-10
        theirs = {}
        for (i, _), w in zip(x, centred @ vectors[:, c] / math.sqrt(values[c])):
            theirs.setdefault(i, []).append(w)
        a = np.array([v for i in sorted(mine, key=str) for v in sorted(mine[i])])
        plus = np.array([v for i in sorted(theirs, key=str) for v in sorted(theirs[i])])
        minus = np.array([v for i in sorted(theirs, key=str) for v in sorted(-w for w in theirs[i])])
        assert min(np.abs(a - plus).max(), np.abs(a - minus).max()) < 1e-6


def vectors(n, d, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, d)) @ np.diag(np.linspace(spread, 0.2, d))
    return [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("n, d, k", [(200, 6, 32), (300, 40, 5), (120, 24, 24)])
def test_equals_full_eigenvectors(spark, n, d, k):
    rows = vectors(n, d, n)
    check(rows, whitening.whiten(make(spark, rows), k).collect(), k)


def test_query_on_its_table(spark, tmp_path):
    rows = vectors(150, 64, 7)
    make(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = op12_whitening(spark, str(tmp_path))
    assert found.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
        ("explained", "double"), ("identity_error", "double"),
    ]
    check(rows, found.collect(), 32)


def test_awkward_rows_take_no_part(spark):
    rows = vectors(60, 4, 1) + [(None, [0.5, 0.25, -0.5, 1.0]), (3, [1.0, 0.0, 0.0, 0.0])] + vectors(60, 4, 1)[:10]
    odd = [(100, None), (101, [None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 4), (103, [float("inf")] * 4), (104, [1.0]), (105, [])]
    check(rows, whitening.whiten(make(spark, rows + odd), 3).collect(), 3)


def test_no_rows_no_variance_and_low_rank(spark):
    assert whitening.whiten(make(spark, [(1, None)])).count() == 0
    assert whitening.whiten(make(spark, [(1, [])])).count() == 0
    assert whitening.whiten(make(spark, [(i, [0.5, 0.25]) for i in range(5)])).count() == 0
    rows = [(i, [0.25 * i, 0.5 * i, 1.0]) for i in range(20)]
    got = whitening.whiten(make(spark, rows), 3).collect()
    assert {r.component for r in got} == {1}
    check(rows, got, 3)


def test_exact_where_64_bits_are_short(spark):
    rows = [(i, [float(np.float32(2.0**40 * (i % 7))), 0.25 * i]) for i in range(30)]
    check(rows, whitening.whiten(make(spark, rows), 1).collect(), 1)


class Counted:
    def __init__(self, matrix):
        self.matrix, self.columns = matrix, 0

    def __matmul__(self, block):
        self.columns += block.shape[1]
        return self.matrix @ block


@pytest.mark.parametrize("seed", range(4))
def test_jacobi_davidson_meets_double_precision(seed):
    rng = np.random.default_rng(seed)
    d = 400
    basis, _ = np.linalg.qr(rng.normal(size=(d, d)))
    true = np.sort(np.concatenate([[100, 50, 50, 49.999, 20] * 2, rng.uniform(0, 15, d - 10)]))[::-1]
    operator = Counted(basis @ np.diag(true) @ basis.T)
    values, found, norms = whitening.eigenpairs(operator, d, 12)
    assert np.abs(values - true[:12]).max() < 1e-11 and norms.max() < 1e-11
    assert np.abs(found.T @ found - np.eye(12)).max() < 1e-12


def test_minres_solves_the_projected_systems():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    u = [np.linalg.qr(rng.normal(size=(30, 3)))[0] for _ in range(4)]
    theta, b = rng.normal(size=4), rng.normal(size=(30, 4))
    got = whitening._minres(lambda x: a @ x, theta, u, b, 60, 1e-13)
    for j in range(4):
        p = np.eye(30) - u[j] @ u[j].T
        want = np.linalg.lstsq(p @ (a - theta[j] * np.eye(30)) @ p, p @ b[:, j], rcond=1e-10)[0]
        assert np.abs(got[:, j] - want).max() < 1e-8
