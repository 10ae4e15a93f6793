import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starbi.llm import eigen, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, None) for i, v in vectors], SCHEMA)


def grid(v):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]


def brute(vectors, width):
    """{id: (n, deviation)}, covariance eigenvalues and whitened values by numpy."""
    good = [(i, grid(v)) for i, v in vectors if v and len(v) == width
            and all(c is not None and math.isfinite(c) for c in v)]
    fit = [list(t) for t in {tuple(x) for _, x in good}]
    n, sums = len(fit), [sum(col) for col in zip(*fit)]
    z = np.array([[x - s / n for x, s in zip(row, sums)] for row in fit])
    values, vectors_ = np.linalg.eigh(z.T @ z / n)
    return good, n, sums, values[::-1], vectors_[:, ::-1], float(np.trace(z.T @ z / n))


def check(spark, vectors, width, components):
    got = whitening.whiten(table(spark, vectors)).collect()
    good, n, sums, values, basis, trace = brute(vectors, width)
    assert len(got) == len(good) * components
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    for i, x in good:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for k in range(components):
            rows = by_id[i][k + 1]
            assert {r.n for r in rows} == {n}
            if sum(j == i for j, _ in good) == 1:
                assert {r.deviation for r in rows} == {deviation if deviation < 1 << 63 else None}
                want = sum((a - s / n) * b for a, s, b in zip(x, sums, basis[:, k])) / math.sqrt(values[k])
                assert abs(abs(rows[0].whitened) - abs(want)) < 1e-6 * (1 + abs(want))
            assert abs(rows[0].explained - values[k] / trace) < 1e-9
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-8


def spread(rng, count, width):
    return [(i, [rng.gauss(0, 1 + j) / 4 for j in range(width)]) for i in range(count)]


@pytest.mark.parametrize("width, components", [(1, 1), (2, 2), (5, 5), (40, 16)])
def test_against_numpy(spark, width, components):
    rng = random.Random(width)
    vectors = spread(rng, 300, width)
    vectors += [(1000 + i, vectors[7][1]) for i in range(200)]  # copies count once
    check(spark, vectors, width, components)


def test_awkward_rows(spark):
    rng = random.Random(3)
    vectors = spread(rng, 60, 4)
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, math.nan, 0.0, 0.0]),
           (104, [1.0, math.inf, 0.0, 0.0]), (105, [-math.inf, 0.0, 0.0, 0.0]), (106, [1.0, 2.0]),
           (None, vectors[0][1]), (5, vectors[5][1]), (6, vectors[1][1])]
    check(spark, vectors + bad, 4, 4)
    clash = table(spark, vectors).select("*", *[F.lit("x").alias(c) for c in ("x", "v", "d", "n", "dim",
                                                                              "component", "deviation")])
    assert whitening.whiten(clash).count() == 240


def test_no_variance_gives_no_rows(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None)])).count() == 0
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    # rank 1 in three dimensions: one component
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(50)]
    rows = whitening.whiten(table(spark, line)).collect()
    assert {r.component for r in rows} == {1} and len(rows) == 50
    assert abs(rows[0].explained - 1) < 1e-12


def test_huge_entries_do_not_overflow(spark):
    vectors = [(i, [float(10.0 ** (i % 38)), float(i), -float(i * i)]) for i in range(40)]
    rows = whitening.whiten(table(spark, vectors)).collect()
    assert {r.vec_id for r in rows} == set(range(40))
    assert all(math.isfinite(r.whitened) for r in rows) and any(r.deviation is None for r in rows)


def test_a_vector_that_a_third_of_the_rows_share(spark):
    rng = random.Random(9)
    vectors = spread(rng, 400, 8)
    vectors += [(1000 + i, vectors[0][1]) for i in range(800)]
    got = whitening.whiten(table(spark, vectors).repartition(16))
    assert got.count() == 1200 * 8
    same = got.where("vec_id >= 1000").groupBy("component").agg(
        (F.max("whitened") - F.min("whitened")).alias("w"), F.max("n").alias("n")).collect()
    assert all(abs(r.w) < 1e-12 and r.n == 400 for r in same)


def spectra():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    x = rng.standard_normal((100, 40))
    yield x.T @ x
    yield np.eye(7)
    yield np.full((9, 9), 2.0)
    yield q @ np.diag(np.repeat([9.0, 9.0, 4.0, 1.0], 10)) @ q.T  # tied eigenvalues
    yield q @ np.diag(np.r_[1e12, np.ones(39)]) @ q.T
    yield np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield np.array([[3.0]])
    yield np.array([[2.0, 1.0], [1.0, 2.0]]) * 1e-200


def test_eigenpairs(spark):
    for a in spectra():
        values, vectors = eigen.leading(a, 16)
        scale = np.abs(a).max()
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:16]).max() < 1e-13 * scale * len(a)
        assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * scale * len(a)
        assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() < 1e-13
    diagonal, off, _ = eigen.tridiagonal(a := next(spectra()))
    at = np.array([-1.0, 10.0, 60.0, 1e6])
    assert eigen.count_below(diagonal, off, at).tolist() == \
        [int((np.linalg.eigvalsh(a) < x).sum()) for x in at]
