import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.helpers import ordered
from starbi.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"
def anchor():
    return F.col("vec_id") % 10 == 0


def brute(rows, width, positives=5, count=3, every=10):
    def usable(v):
        return v and len(v) == width and all(c is not None and math.isfinite(c) for c in v)
    good = [(k, i, [math.floor(256 * float(np.float32(c))) for c in v], y)
            for k, (i, v, y) in enumerate(rows) if i is not None and y is not None and usable(v)]
    out = []
    for k, i, x, y in good:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(x, z)), j, m, label) for m, j, z, label in good]
        tops = sorted(s for s in scored if s[3] == y and s[2] != k)[:positives]
        for p in tops:
            inside = sorted(s for s in scored if s[3] != y and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0])
            out += [(i, p[1], r, s[1], -p[0], -s[0]) for r, s in enumerate(inside[:count], 1)]
    return ordered(out)


def vectors(rng, n, width, labels=3, centres=0):
    middle = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(centres)]
    out = []
    for i in range(n):
        base = middle[i % centres] if centres else [0.0] * width
        spread = 0.2 if centres else 0.5
        out.append((i, [b + rng.gauss(0, spread) for b in base], rng.randrange(labels)))
    return out


@pytest.mark.parametrize("width, centres, block", [(64, 0, 32_768), (64, 8, 20), (7, 0, 32_768), (1, 0, 15)])
def test_against_brute_force(spark, width, centres, block):
    rows = vectors(random.Random(width + centres), 300, width, centres=centres)
    got = negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(5), anchor(), block=block)
    want = brute(rows, width)
    assert len(want) > 20 and ordered(got.collect()) == want


def test_awkward_rows(spark):
    rows = vectors(random.Random(2), 80, 4)
    v = rows[0][1]
    rows += [(100, None, 1), (110, [], 1), (120, [1.0, None, 0.0, 0.0], 1), (130, v, None),
             (140, [1.0, math.nan, 0.0, 0.0], 1), (150, [math.inf] * 4, 1), (160, [1.0, 2.0], 1),
             (None, v, 1), (0, v, 0), (0, v, 0), (10, rows[10][1], rows[10][2]), (-20, v, 2),
             (20, rows[3][1], 5), (170, [0.0] * 4, 1), (180, [0.0] * 4, 2), (190, [-x for x in v], 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    # one id in two rows: ids cannot tell them apart, so compare the sets of rows
    want = brute(rows, 4)
    assert ordered(negatives.mine(df.coalesce(1), anchor()).collect()) == want
    more = df.select("*", *[F.lit("x").alias(c) for c in ("x", "v", "rid", "slot", "mean", "score", "rank")])
    assert ordered(negatives.mine(more.coalesce(1), anchor()).collect()) == want
    assert negatives.mine(df.limit(0), anchor()).count() == 0
    assert negatives.mine(df.where("vec_id = 7"), anchor()).count() == 0


def test_a_vector_that_a_third_of_the_rows_share(spark):
    rng = random.Random(4)
    rows = vectors(rng, 200, 16)
    rows += [(1000 + i, rows[0][1], rng.randrange(3)) for i in range(100)]
    got = negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(4), anchor())
    assert ordered(got.collect()) == brute(rows, 16)


def test_scores_are_exact_beyond_a_double(spark):
    rows = [(10 * i, [2.0 ** 18 + i, 2.0 ** 18 - i, 1.0], i % 2) for i in range(8)]
    got = negatives.mine(spark.createDataFrame(rows, SCHEMA), anchor())
    assert got.count() == 0  # nothing lies below 95 % of the positive
    a = np.array([[2 ** 26, 2 ** 26, 1]])
    assert negatives.scores(a, a).tolist() == [[2 ** 53 + 1]]


def test_bounds_hold_and_close_pairs():
    rng = np.random.default_rng(6)
    x = rng.integers(-300, 300, (200, 50))
    y = np.repeat(rng.integers(-300, 300, (200, 4)), 13, axis=1)[:, :50]
    for a in (x, y):
        for b in (x, y):
            exact = negatives.scores(a, b)
            wide = None
            for (ma, da), (mb, db) in zip(negatives.levels(*negatives.segment_summary(a)),
                                          negatives.levels(*negatives.segment_summary(b))):
                middle, radius = ma @ mb.T, da @ db.T + 1e-6
                assert (middle - radius <= exact).all() and (exact <= middle + radius).all()
                assert wide is None or radius.mean() <= wide
                wide = radius.mean()


def test_segments_close_most_pairs_of_smooth_vectors():
    import pyarrow as pa
    rng = np.random.default_rng(8)
    x = np.repeat(rng.integers(-300, 300, (400, 4)), 16, axis=1) + rng.integers(-5, 5, (400, 64))
    mean, deviation = negatives.segment_summary(x)
    v = negatives.Vectors(pa.table({"rid": range(400), "vec_id": range(400), "label": [0] * 400,
                                    "x": list(x), "mean": list(mean), "deviation": list(deviation)}))
    exact = negatives.scores(v.x, v.x)
    fifth = np.sort(exact, axis=1)[:, -5].astype(float)
    for i in range(0, 400, 50):
        at, rows = negatives.open_pairs(v, np.array([i]), v, np.arange(400), fifth)
        assert set(np.flatnonzero(exact[i] >= fifth[i])) <= set(rows) and len(rows) < 40
