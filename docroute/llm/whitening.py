"""Embedding whitening from exact cross-products by bit-sliced scatter.

Every entry c becomes the integer x = floor(1024 c) + 100000. The rows of a batch are shifted by each dimension's
smallest x, so few bits are left, and each bit of each dimension is packed across rows into 64-bit words: its planes.
The product sum of two dimensions is the sum over plane pairs (a, b) of 2^(a + b) times the ones in plane a AND plane
b. The shift is undone in integers, batches and tasks add up exactly, and n Sxy - Sx Sy, over n squared, is the covariance:
centred in integers, rounded once. Its eigenvectors are taken on the driver, from a matrix that the vectors' length
bounds, whatever the number of rows.

Cases: rows whose vector is null or empty, or has a null or non-finite entry, drop out; where vectors differ in length
the most frequent length stays (the smaller among equally frequent ones); x stops at +-2^61; a null vec_id stays null;
rows that repeat count as often as they occur; other columns are not read; an empty table gives no row. A component
without variance (equal vectors, one row, or a rounding error of it) has whitened 0 everywhere and takes no part in the
identity error. Deviations are exact decimal text, since they outgrow a long from some millions of rows on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Rows whose planes are met at a time, a multiple of 64.
ROWS = 1024
_LIMIT = 2.0**61
#: Variance below this share of the whole is rounding.
_NOTHING = 1e-13
_LOW = 60


def finite(vector: Column) -> Column:
    """A vector with entries, all of them numbers."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ok, F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of an Arrow column, all of one length, as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def integers(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * SCALE), -_LIMIT, _LIMIT).astype(np.int64) + SHIFT


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """[word, dimension, bit]: the bits of non-negative integers [row, dimension], packed across rows."""
    n, dim = y.shape
    out = np.zeros((-(-n // 64), dim, bits), np.uint64)
    for b in range(bits):
        ones = np.zeros((len(out) * 64, dim), np.uint8)
        ones[:n] = y >> b & 1
        out[:, :, b] = np.ascontiguousarray(np.packbits(ones, axis=0).T).view(np.uint64).T
    return out


def products(y: np.ndarray) -> np.ndarray:
    """The sums of y_i y_j over rows (upper triangle), from AND-popcounts of bit planes weighted by powers of two."""
    dim = y.shape[1]
    bits = max(1, int(y.max()).bit_length())
    exact = np.int64 if 2 * bits + len(y).bit_length() < 63 else object
    weight = np.array([[1 << (a + b) for b in range(bits)] for a in range(bits)], exact)
    out = np.zeros((dim, dim), exact)
    for start in range(0, len(y), ROWS):
        p = planes(y[start : start + ROWS], bits)
        for i in range(dim):
            both = np.bitwise_count(p[:, i, None, :, None] & p[:, i:, None, :])
            ones = np.add.reduce(both, axis=0, dtype=np.uint16).astype(exact)
            out[i, i:] += (ones * weight).sum(axis=(1, 2))
    return out


def _scatter(vectors: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, sums of products) of the x-vectors, in Python integers; collected are (dim + 1)(dim + 2) / 2 sums."""
    places = [(i, j) for i in range(dim + 1) for j in range(i, dim + 1)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = integers(matrix(batch.column(0), dim)) - SHIFT
            low = x.min(axis=0)
            y = x - low
            n, low, sums = len(x), low.astype(object), np.array([int(c.sum()) if int(c.max()) * len(c) < 1 << 62 else sum(c.tolist()) for c in y.T], object)
            total[0, 0] += n
            total[0, 1:] += sums + n * low
            total[1:, 1:] += np.triu(products(y).astype(object) + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low))
        values = [int(total[p]) for p in places]
        i, j = zip(*places)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(v >> _LOW) for v in values]), pa.array([v & (1 << _LOW) - 1 for v in values], pa.int64())],
            ["i", "j", "high", "low"])

    parts = vectors.select("embedding").mapInArrow(rows, "i int, j int, high string, low long")
    sums = parts.groupBy("i", "j").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    g = {(r.i, r.j): (int(r.high) << _LOW) + int(r.low) for r in sums.collect()}
    n = g.get((0, 0), 0)
    # the sums leave the constant out, so that they stay small; it moves S and no product of centred numbers
    return n, [g[0, i + 1] for i in range(dim)] if n else [], [[g[min(i, j) + 1, max(i, j) + 1] for j in range(dim)] for i in range(dim)] if n else []


class Whitening:
    """Means, components and eigenvalues of one fit; small, and sent to every task."""

    def __init__(self, n: int, sums: list[int], cross: list[list[int]], components: int):
        dim = len(sums)
        spread = [[n * cross[i][j] - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]
        values, axes = np.linalg.eigh(np.array([[v / (n * n) for v in row] for row in spread]))
        trace = sum(spread[i][i] for i in range(dim)) / (n * n)
        order = np.argsort(-values, kind="stable")[:components]
        self.n, self.sums, self.dim = n, sums, dim
        self.axes, self.values = axes[:, order], np.maximum(values[order], 0.0)
        self.live = self.values > _NOTHING * trace
        self.explained = [float(v / trace) if trace else 0.0 for v in self.values]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact; Python integers where a long could overflow."""
        top = max(1, int(np.abs(x).max(initial=0)), *map(abs, self.sums))
        kind = np.int64 if 2 * self.n * top < 1 << 62 else object
        return self.n * x.astype(kind) - np.array(self.sums, kind)

    def project(self, centred: np.ndarray) -> np.ndarray:
        scale = np.where(self.live, 1 / np.sqrt(np.where(self.live, self.values, 1.0)), 0.0)
        return (centred.astype(np.float64) / self.n) @ self.axes * scale

    @staticmethod
    def deviations(centred: np.ndarray) -> list[str]:
        top = int(np.abs(centred).max(initial=0))
        if top * top * centred.shape[1] >= 1 << 63:
            centred = centred.astype(object)
        return [str(v) for v in (centred * centred).sum(axis=1).tolist()]


def _identity_error(vectors: DataFrame, fit: Whitening) -> float:
    """The largest difference from the identity in the covariance of the whitened rows themselves."""
    k = len(fit.values)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = fit.project(fit.centred(integers(matrix(batch.column(0), fit.dim)) - SHIFT))
            w = np.concatenate((np.ones((len(w), 1)), w), axis=1)
            total += w.T @ w
        i, j = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "value"])

    sums = np.zeros((k + 1, k + 1))
    for r in vectors.select("embedding").mapInArrow(rows, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        sums[r.i, r.j] = r.value
    mean = sums[0, 1:] / fit.n
    off = np.abs(sums[1:, 1:] / fit.n - np.outer(mean, mean) - np.eye(k))[np.ix_(fit.live, fit.live)]
    return float(off.max(initial=0.0))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, n, deviation, whitened, explained, identity_error), one row per vector of (vec_id, embedding).

    `deviation` is decimal text; `whitened` and `explained` hold a number per component, by falling eigenvalue.
    """
    schema = "vec_id long, deviation string, whitened array<double>"
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").where(finite(F.col("embedding")))
    sizes = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return rows.sparkSession.createDataFrame([], "vec_id long, n long, deviation string, whitened array<double>, explained array<double>, identity_error double")
    dim = sizes["dim"]
    rows = rows.where(F.size("embedding") == dim)
    fit = Whitening(*_scatter(rows, dim), components)
    error = _identity_error(rows, fit)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = fit.centred(integers(matrix(batch.column(1), fit.dim)) - SHIFT)
            out = fit.project(centred)
            offsets = np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fit.deviations(centred), pa.string()), pa.ListArray.from_arrays(offsets, out.ravel())], ["vec_id", "deviation", "whitened"])

    out = rows.mapInArrow(project, schema)
    return out.select("vec_id", F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", F.array(*map(F.lit, fit.explained)).alias("explained"), F.lit(error).alias("identity_error"))
