"""Embedding whitening with mixed-precision eigenvectors.

Sums and covariance are gathered by Spark as one d x d matrix; rows never are. Its eigenvectors are first found
in float32 and then corrected by Ogita-Aishima steps, which are matrix products in extended precision:
from R = I - X'X and S = X'AX each step makes a correction whose error is the square of the last.
Eigenvalues closer than the step can tell apart form clusters; inside each, a small symmetric problem,
shifted by the cluster's mean so that its own precision suffices, is solved and turns the cluster's vectors.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from . import query
from .common import ship, table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
STEPS = 20  # at most; five are usual, each cluster takes some more
ROWS = 8192  # vectors in one product


def _clusters(close: np.ndarray) -> list[np.ndarray]:
    """Index sets, two or more each, that chains of close eigenvalues connect."""
    left, found = set(range(len(close))), []
    while left:
        todo = [left.pop()]
        members = list(todo)
        while todo:
            new = [j for j in np.flatnonzero(close[todo.pop()]) if j in left]
            left.difference_update(new)
            members += new
            todo += new
        if len(members) > 1:
            found.append(np.sort(np.array(members)))
    return found


def _steps(a: np.ndarray, x: np.ndarray, steps: int) -> np.ndarray:
    """Eigenvectors ``x`` of symmetric ``a``, corrected in the precision of ``a``."""
    x = x.astype(a.dtype)
    one, eps = np.eye(len(a), dtype=a.dtype), np.finfo(a.dtype).eps
    size = np.sqrt((a * a).sum())
    for _ in range(steps):
        r, s = one - x.T @ x, x.T @ a @ x
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(value)
        told = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
        gap = value[None, :] - value[:, None]
        close = np.abs(gap) <= told
        e = np.where(close, r / 2, (s + value[None, :] * r) / np.where(close, 1, gap))
        x = x + x @ e
        moved = np.abs(e).max()
        np.fill_diagonal(close, False)
        for at in _clusters(close & (np.abs(gap) > 8 * eps * size)):
            y = x[:, at]
            small = y.T @ (a @ y) - value[at].mean() * (y.T @ y)
            scale = np.abs(small).max() or 1
            _, turn = np.linalg.eigh(((small + small.T) / (2 * scale)).astype(np.float64))
            x[:, at] = y @ turn.astype(a.dtype)
            np.fill_diagonal(small, 0)
            moved = max(moved, np.abs(small).max() / size)
        if moved <= 4 * eps * len(a):
            break
    for _ in range(3):  # what lies closer than precision tells is made orthogonal without preference
        x = x + x @ ((one - x.T @ x) / 2)
    return x


def refine(a: np.ndarray, x: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of symmetric ``a`` from approximate ones ``x``, in extended precision, in no order.

    The first steps run in double, the last ones in the longest precision that numpy has.
    """
    x = _steps(a.astype(np.float64), x, steps)
    a = a.astype(np.longdouble)
    x = _steps(a, x, steps)
    x = x / np.sqrt((x * x).sum(0))
    return (x * (a @ x)).sum(0), x


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a covariance, to double precision."""
    scale = np.abs(a).max() or 1.0
    _, x = np.linalg.eigh((a / scale).astype(np.float32))
    value, x = refine(a / scale, x)
    order = np.argsort(-value, kind="stable")
    return np.maximum(value[order], 0).astype(np.float64) * scale, x[:, order].astype(np.float64)


def fixed_point(vector: str) -> Column:
    """Each entry c of an array column as the long floor(64 c) + 1000000."""
    return F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET).cast("bigint"))


def usable(vector: str) -> Column:
    """The vector is there, has entries, and none of them is null, NaN or infinite."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~odd, F.lit(False))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(batches, column: int = 0):
    for b in batches:
        for k in range(0, b.num_rows, ROWS):
            part = b.slice(k, ROWS)
            yield part, _matrix(part.column(column))


def _sums(batches):
    """(dimension, sum as text) of one partition's integer vectors; dimension -1 counts the vectors."""
    import pyarrow as pa

    n, total = 0, []
    for _, x in _blocks(batches):
        exact = x if int(np.abs(x).max()) < (1 << 62) // len(x) else x.astype(object)
        n, total = n + len(x), [a + int(b) for a, b in zip(total or [0] * x.shape[1], exact.sum(0))]
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()), pa.array([str(v) for v in [n, *total]])], names=["i", "s"])


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums/n in double: the whole part of the mean is taken off exactly, the rest after."""
    whole = [s // n for s in sums]
    return (x - np.array(whole, np.int64)).astype(np.float64) - np.array([(s - w * n) / n for s, w in zip(sums, whole)])


def _products(n: int, sums: list[int], w: np.ndarray | None):
    """Rows (i, values) of one partition's sum of y y', y the centred vector or its projection on w."""
    import pyarrow as pa

    def run(batches):
        g = 0
        for _, x in _blocks(batches):
            y = _centred(x, n, sums)
            y = y if w is None else y @ w
            g = g + y.T @ y
        if not np.isscalar(g):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(g)), pa.int32()), pa.array(list(g), pa.list_(pa.float64()))], names=["i", "v"])

    return run


def _added(batches):
    """One row for each i: the sum of its arrays."""
    import pyarrow as pa

    total = {}
    for b in batches:
        for i, v in zip(b.column(0).to_pylist(), _matrix(b.column(1)) if b.num_rows else ()):
            total[i] = total[i] + v if i in total else v.copy()
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], names=["i", "v"])


def covariance(fit: DataFrame, n: int, sums: list[int], w: np.ndarray | None = None) -> np.ndarray:
    """Covariance, divisor n, of the vectors fit(x), or of their projection on ``w``; d numbers a partition and row of
    the matrix are shuffled, the matrix alone comes to the driver."""
    kind = "i int, v array<double>"
    parts = fit.select("x").mapInArrow(_products(n, sums, w), kind)
    rows = sorted(parts.repartition("i").mapInArrow(_added, kind).collect())
    return np.array([r.v for r in rows]) / n


def _projected(n: int, sums: list[int], w: np.ndarray, live: np.ndarray):
    """(id, deviation, whitened) of (id, x) batches."""
    import pyarrow as pa

    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)

    def run(batches):
        for part, x in _blocks(batches, 1):
            d = x - whole
            bound = (int(np.abs(d).max()) + 1) * n
            d = d if bound * bound * len(sums) < 1 << 63 else d.astype(object)
            deviation = ((d * n - rest) ** 2).sum(1)
            y = _centred(x, n, sums) @ w
            white = [[v if ok else None for v, ok in zip(r, live)] for r in y.tolist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([Decimal(int(v)) for v in deviation], pa.decimal128(38, 0)), pa.array(white, pa.list_(pa.float64()))],
                names=["id", "deviation", "whitened"])

    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each usable row and component.

    Vectors become fixed-point integers; the fit list holds each different one once, however many rows
    repeat it, so a hot vector collapses in a combined aggregate. n and sums are exact. Components run from 1
    by falling eigenvalue; an eigenvalue that is zero to double precision has whitened null (one vector alone,
    equal vectors) and is left out of identity_error, which is null if none is left. deviation is an exact
    decimal. Rows whose vector is null, empty, or holds null, NaN or infinite entries go; vectors
    of different lengths are an error; entries beyond 2^56 do not fit a long and are one too. Repeated rows
    and null ids each get theirs. An empty table gives an empty one. Other columns are not looked at.
    """
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType.simpleString()
    ship(spark)
    picked = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("e"))
    picked = picked.where(usable("e")).select("id", fixed_point("e").alias("x"))
    fit = stored(picked.select("x").distinct())
    least, most = fit.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if least is None:
        empty = f"`{id_col}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return spark.createDataFrame([], empty)
    if least != most:
        raise ValueError(f"vectors have from {least} to {most} entries")
    totals = fit.mapInArrow(_sums, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    n, *sums = (int(r.s) for r in sorted(totals.collect()))
    v = covariance(fit, n, sums)
    value, x = eigen((v + v.T) / 2)
    k = min(components, len(value))
    live = value[:k] > 8 * len(value) * np.finfo(np.float64).eps * max(value[0], np.finfo(np.float64).tiny)
    w = x[:, :k] / np.sqrt(np.where(live, value[:k], 1))
    error = None
    if live.any():
        error = float(np.abs(covariance(fit, n, sums, w[:, live]) - np.eye(live.sum())).max())
    share = (value[:k] / value.sum()).tolist() if value.sum() else [None] * k

    made = picked.mapInArrow(_projected(n, sums, w, live), f"id {kind}, deviation decimal(38,0), whitened array<double>")
    rows = made.select("id", "deviation", F.posexplode("whitened").alias("at", "white"))
    return rows.select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        F.col("white").alias("whitened"), F.get(F.array(*(F.lit(s).cast("double") for s in share)), "at").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark, sf_dir):
    """The first 16 whitened components of every usable row of embeddings. A deviation past a long is null."""
    rows = whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("bigint"))
