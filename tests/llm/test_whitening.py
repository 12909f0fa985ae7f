import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, wanted=4):
    """(n, S, eigenvalues, trace, deviations by row) from a whole covariance matrix."""
    whole = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in whole})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array(sums) / n
    cov = centred.T @ centred / n
    return n, sums, np.linalg.eigvalsh(cov)[::-1][:wanted], np.trace(cov), [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), x) for i, x in whole], cov


def check(found, rows, k):
    n, sums, values, trace, whole, cov = brute(rows)
    assert len(found) == k * len(whole)
    assert {r.n for r in found} == {n} and {r.component for r in found} == set(range(1, k + 1))
    for c in range(k):
        assert [r.explained for r in found if r.component == c + 1] == pytest.approx([values[c] / trace] * len(whole), rel=1e-9)
    assert found[0].identity_error < 1e-9
    by_row = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    assert by_row.keys() == {(i, d) for i, d, _ in whole}
    # Whitened vectors give the components back: unit, orthogonal, with the residual of an eigenvector.
    mean = np.array(sums) / n
    x = np.array([x for _, _, x in whole], float) - mean
    white = np.array([[by_row[i, d][c + 1][0] for c in range(k)] for i, d, _ in whole])
    u = np.linalg.lstsq(x, white * np.sqrt(values[:k]), rcond=None)[0]
    assert np.abs(x @ u - white * np.sqrt(values[:k])).max() < 1e-8 * np.abs(x).max()
    if np.linalg.matrix_rank(x) == x.shape[1]:
        assert np.abs(u.T @ u - np.eye(k)).max() < 1e-9
        assert np.abs(cov @ u - u * values[:k]).max() < 1e-9 * values[0]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_a_whole_matrix(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(i), (v * [1, 2, 3, 1, 1, 0.5, 0.2, 5]).tolist()) for i, v in enumerate(rng.standard_normal((300, 8)) + 4)]
    # A hot vector, repeated ids, negative zero, and what takes no part.
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [(5, rows[9][1]), (None, rows[3][1]), (6, [-0.0] * 8), (6, [0.0] * 8)]
    rows += [(2000, None), (2001, [None] + [1.0] * 7), (2002, [math.nan] * 8), (2003, [math.inf] + [0.0] * 7)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("x", F.lit("clash")).withColumn("n", F.lit(1))
    found = whitening.whiten(frame).collect()
    check(found, rows, 4)


def test_other_dimensions_are_left_out(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((40, 3)))]
    found = whitening.whiten(spark.createDataFrame([*rows, (90, [1.0]), (91, []), (92, [1.0] * 5)], SCHEMA)).collect()
    check(found, rows, 3)


def test_directions_without_variance_are_left_out(spark):
    rng = np.random.default_rng(5)
    flat = [(i, [float(a), float(a) * 2, 1.0, float(b)]) for i, (a, b) in enumerate(rng.integers(-9, 9, (60, 2)))]
    check(whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect(), flat, 2)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [3.0]), (2, [3.0])], [(1, None)], [(1, []), (2, [])]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_large_numbers_are_exact_or_fail(spark):
    rows = [(i, [1e6 + i, float(i % 3)]) for i in range(500)]
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), rows, 2)
    for far in (1e15, 1e18):
        with pytest.raises(Exception, match="does not fit a long|too large"):
            whitening.whiten(spark.createDataFrame([(1, [far]), (2, [0.0])], SCHEMA)).collect()


@pytest.mark.parametrize("values", [[5, 5, 5, 5, 1, 1], [9, 8, 7, 6, 5, 4, 3, 2, 1], list(range(1, 61)), [1e6, 1, 1e-6, 0, 0], [1] * 40])
def test_eigenpairs(values):
    rng = np.random.default_rng(6)
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    matrix = q * np.array(values, float) @ q.T
    found, vectors, residuals = whitening.leading_eigenpairs(lambda z: matrix @ z, len(values))
    assert np.abs(found - sorted(values, reverse=True)[:4]).max() < 1e-12 * max(values)
    assert residuals.max() < 1e-12 * max(values) and np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12
