"""Whitening against numpy over all rows in memory, and the eigenvector steps on hard matrices."""

import math
from collections import Counter

import numpy as np
import pytest
from tidepool.llm import whiten

COLUMNS = "vec_id bigint, embedding array<float>, n int, component string, x double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 0.5) for i, v in rows], COLUMNS).repartition(3)


@pytest.mark.parametrize("values", [
    np.linspace(100, 50, 40), np.r_[[100] * 5, [90] * 3, np.linspace(80, 1, 20)], np.r_[1e6, 1, 1, 1e-6, 1e-6, 0, 0],
    np.r_[100, 100 - 1e-9, 100 - 2e-9, 99, np.linspace(50, 49.9, 28)], np.r_[[3.0] * 30, 3 + 1e-7, 3 - 1e-7], np.ones(5), np.zeros(3), np.ones(1)])
def test_eigenvectors(values):
    q, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(len(values),) * 2))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    value, x = whiten.eigen(a)
    size = np.abs(values).max() or 1
    assert (np.diff(value) <= 0).all()
    assert np.abs(value - np.sort(values)[::-1]).max() < 1e-13 * size
    assert np.abs(x.T @ x - np.eye(len(x))).max() < 1e-14
    assert np.abs(a @ x - x * value).max() < 1e-14 * size  # a double eigensolver alone leaves some 1e-14 here


def test_float32_alone_would_not_do():
    a = np.random.default_rng(2).normal(size=(60, 60))
    a = a @ a.T
    value, x = np.linalg.eigh(a.astype(np.float32))
    assert np.abs(a @ x - x * value).max() > 1e-10 * value.max()  # the bound above is 1e-14


def expected(rows, most=16):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    ints = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in kept}
    fit = sorted({tuple(x) for x in ints.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[c - s / n for c, s in zip(x, sums)] for x in fit])
    value, vec = np.linalg.eigh(y.T @ y / n)
    return ints, n, sums, value[::-1], vec[:, ::-1], most


def check(spark, rows):
    got = whiten.whiten(frame(spark, rows)).collect()
    ints, n, sums, value, vec, most = expected(rows)
    k = min(most, len(sums))
    assert Counter((r.vec_id, r.component) for r in got) == Counter((i, c) for i, v in rows if i in ints and v and all(
        c is not None and math.isfinite(c) for c in v) for c in range(1, k + 1))
    sign = {}
    for r in got:
        x, c = ints[r.vec_id], r.component - 1
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert abs(r.explained - value[c] / value.sum()) < 1e-9 and r.identity_error < 1e-9
        want = sum((a - s / n) * b for a, s, b in zip(x, sums, vec[:, c])) / math.sqrt(value[c])
        if abs(want) > 1e-6:
            sign.setdefault(c, np.sign(want * r.whitened))
            assert abs(r.whitened - sign[c] * want) < 1e-8
    return got


def test_whitening(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in rng.normal(size=20) * np.linspace(3, 1, 20)]) for k in range(400)]
    rows += [(1000 + k, rows[0][1]) for k in range(300)]  # a hot vector counts once
    rows += [(2000, None), (2001, []), (2002, [None] + [0.1] * 19), (2003, [float("nan")] * 20), (2004, [float("-inf")] * 20), (3, rows[3][1])]
    check(spark, rows)


def test_fewer_dimensions_than_components(spark):
    rng = np.random.default_rng(4)
    check(spark, [(k, [float(c) for c in rng.normal(size=3)]) for k in range(60)])


def test_large_entries_stay_exact(spark):
    rows = [(k, [float(2**30 + (k * 7919 % 1000) * 4096), float(k % 13)]) for k in range(200)]
    got = whiten.whiten(frame(spark, rows)).collect()
    ints, n, sums, *_ = expected(rows)
    assert all(r.deviation == sum((n * a - s) ** 2 for a, s in zip(ints[r.vec_id], sums)) for r in got)
    huge = [(k, [float(2**50 + k * 2**40)]) for k in range(50)]
    got = whiten.whiten(frame(spark, huge)).collect()
    ints, n, sums, *_ = expected(huge)
    assert all(r.deviation == sum((n * a - s) ** 2 for a, s in zip(ints[r.vec_id], sums)) for r in got) and max(r.deviation for r in got) > 1 << 63


def test_no_spread_no_rows_and_unequal_lengths(spark):
    same = whiten.whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (None, [0.5, 0.25])])).collect()
    assert len(same) == 6 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.identity_error is None for r in same)
    line = whiten.whiten(frame(spark, [(k, [float(k), 1.0]) for k in range(5)])).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-12 for r in line)
    none = whiten.whiten(frame(spark, [(1, None)]))
    assert none.count() == 0 and none.columns == whiten.whiten(frame(spark, [(1, [1.0]), (2, [2.0])])).columns
    with pytest.raises(ValueError):
        whiten.whiten(frame(spark, [(1, [1.0]), (2, [2.0, 3.0])]))
