"""Whitening against exact fractions."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import whiten as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, component string"


def brute(rows, k=4):
    """Integer vectors, n, S, and the covariance in fractions."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in kept), default=0)
    kept = [(i, tuple(min(max(math.floor(256 * float(np.float32(c))), -2 ** 63), 2 ** 63 - 1) for c in v) + (0,) * (d - len(v)))
            for i, v in kept]
    fit = sorted({x for _, x in kept})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    cov = [[Fraction(sum((n * x[a] - s[a]) * (n * x[b] - s[b]) for x in fit), n ** 3) for b in range(d)] for a in range(d)]
    return kept, fit, n, s, cov


def check(spark, rows, k=4):
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA).repartition(3)
    got = W.whiten(df, "vec_id", "embedding", k).collect()
    kept, fit, n, s, cov = brute(rows)
    v = np.array([[float(c) for c in row] for row in cov])
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:k]
    assert len(got) == len(kept) * len(order)
    deviations = sorted((str(i), sum((n * c - t) ** 2 for c, t in zip(x, s))) for i, x in kept)
    by = {}
    for r in got:
        assert r.n == n
        by.setdefault(r.component, []).append(r)
    for c, rs in by.items():
        assert sorted((str(r.vec_id), int(r.deviation)) for r in rs) == deviations
        e, u = values[order[c - 1]], vectors[:, order[c - 1]]
        assert all(r.explained == pytest.approx(e / np.trace(v), rel=1e-9, abs=1e-15) for r in rs)
        if e > 1e-9 * values.max():
            want = sorted((str(i), float(sum(float(Fraction(n * a - t, n)) * w for a, t, w in zip(x, s, u)) / math.sqrt(e))) for i, x in kept)
            own = sorted((str(r.vec_id), r.whitened) for r in rs)
            flipped = sorted((str(r.vec_id), -r.whitened) for r in rs)
            assert any(a == pytest.approx(b, rel=1e-6, abs=1e-7) for a, b in
                       [([x for _, x in own], [x for _, x in want]), ([x for _, x in flipped], [x for _, x in want])])
            assert all(r.identity_error <= 1e-4 for r in rs)
        else:
            assert all(r.whitened is None for r in rs)
    return got


def test_whitening_of_awkward_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(np.float32(c)) for c in rng.normal(0, 0.2, 7) * np.arange(1, 8)]) for k in range(300)]
    rows += [(3, rows[0][1]), (None, rows[1][1]), (900, None), (901, [None] * 7), (902, [float("nan")] + [0.0] * 6),
             (903, [float("inf")] + [0.0] * 6), (904, [1.5, -0.0]), (905, [])]
    rows += [(1000, rows[2][1])] * 150      # a third of the rows are copies
    got = check(spark, rows)
    assert not {r.vec_id for r in got} & {900, 901, 902, 903} and {904, 905} <= {r.vec_id for r in got}


def test_whitening_of_huge_entries_needs_more_than_64_bits(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(np.float32(c)) for c in rng.normal(0, 1, 3) * [1e13, 1e6, 1e13]]) for k in range(60)]
    rows += [(100, [3e38, 0.0, -3e38])]
    kept, fit, n, s, cov = brute(rows)
    t = W.Totals(n, s, [min(c) for c in zip(*fit)], [max(c) for c in zip(*fit)])
    df = spark.createDataFrame([(list(x),) for x in fit], "x array<long>").repartition(4)
    found = W.totals(df)
    assert (found.n, found.sums, found.least, found.most) == (t.n, t.sums, t.least, t.most)
    q = W.squares(df, found)
    assert all(q[i, j] == sum((n * x[i] - s[i] + (n * x[j] - s[j] if i != j else 0)) ** 2 for x in fit) for i in range(3) for j in range(i, 3))
    v = W.covariance(q, n, 3)
    assert all(v[i, j] == float(cov[i][j]) for i in range(3) for j in range(3))


def test_polarised_squares_are_exact_with_several_limbs(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(-200, 200, (500, 5))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<long>").repartition(4)
    t = W.totals(df)
    q, c = W.squares(df, t, limb=5), len(x) * x - x.sum(0)
    assert all(q[i, j] == int(((c[:, i] + (c[:, j] if i != j else 0)) ** 2).sum()) for i in range(5) for j in range(i, 5))


def test_whitening_without_variance_or_rows(spark):
    df = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id long, embedding array<float>")
    got = W.whiten(df, "vec_id", "embedding").collect()
    assert len(got) == 4 and {(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, None, None, None)}
    flat = spark.createDataFrame([(k, [0.1 * k, 0.2 * k, 0.0]) for k in range(9)], "vec_id long, embedding array<double>")
    assert {r.component for r in W.whiten(flat, "vec_id", "embedding").where("whitened IS NULL").collect()} >= {3}
    empty = W.whiten(df.limit(0), "vec_id", "embedding")
    assert empty.count() == 0 and empty.columns == W.whiten(df, "vec_id", "embedding").columns
    assert W.whiten(df.withColumn("embedding", F.array().cast("array<float>")), "vec_id", "embedding").count() == 0


def test_the_query_is_whole(spark):
    rows = W.op12_whitening(spark, "/root/testdata/sf0.001")
    total = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()
    assert rows.count() == 4 * total and dict(rows.dtypes)["deviation"] == "bigint"
    assert rows.agg(F.max("identity_error")).first()[0] < 1e-9
