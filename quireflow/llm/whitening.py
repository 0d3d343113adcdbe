"""Whitening of embeddings with eigenvectors from cyclic Jacobi rotations.

Entries become integers (``scale`` times the entry, floored). The covariance is that of the distinct integer vectors. Its
scatter is summed by the executors around a whole-numbered centre near the mean, in integers, and the difference from the
mean is taken off exactly, so the covariance that the driver gets (a matrix, bounded by the number of dimensions) is right to the last bit
whatever the order of rows. The driver turns it by symmetric Jacobi rotations, sweep after sweep, until all entries off the
diagonal vanish against their diagonal entries; that keeps small eigenvalues accurate. The sorted whitening matrix goes to
the executors with the function that applies it.

Edge cases: rows whose vector is null or holds null, NaN or infinite entries are dropped; repeated vectors count once in the
covariance and are all returned; null and repeated ids are kept; equal eigenvalues keep the order of their dimensions; a component's largest
entry (the first of several) is positive; components whose eigenvalue is zero to double precision cannot be whitened and
are not returned, so a table of one distinct vector, and an empty table, give no rows; other columns are left alone.
Vectors of different lengths, entries whose floor is no 64-bit integer and deviations beyond 64 bits are errors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stored, table

SCALE, COMPONENTS = 256, 4
#: Jacobi sweeps at most; a handful is enough.
SWEEPS = 60
#: Floats hold integers below this exactly.
EXACT = 1 << 53


def whole_entries(vector: str | Column, scale: int) -> Column:
    """Array of longs: floor of scale times each entry."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))


def usable(vector: str | Column) -> Column:
    """Is the vector there, and all its entries finite?"""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf"))
    return F.coalesce(~F.exists(vector, bad), F.lit(False))


def matrix_of(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as int64."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def summed(rows: DataFrame, dims: int, parts: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """Exact totals over all rows x of ``parts`` (a 64-bit integer array from a matrix of rows), in its order.

    A task adds up its own batches as Python integers; its totals leave it in two halves, so that no sum overflows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] | None = None
        for batch in batches:
            if batch.num_rows:
                got = [int(v) for v in parts(matrix_of(batch.column("x"), dims))]
                total = got if total is None else [a + b for a, b in zip(total, got, strict=True)]
        if total is not None:
            columns = [list(range(len(total))), [v >> 40 for v in total], [v & ((1 << 40) - 1) for v in total]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["at", "high", "low"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    got = rows.select("x").mapInArrow(run, "at bigint, high bigint, low bigint").groupBy("at").agg(wide("high").alias("high"), wide("low").alias("low"))
    return [(int(r.high) << 40) + int(r.low) for r in sorted(got.collect(), key=lambda r: r["at"])]


def scatter(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Sums of y and, row by row of the upper triangle, of products of entries of y = x - centre. Exact."""
    y = x - centre
    upper = np.triu_indices(y.shape[1])
    most = int(np.abs(y).max(initial=0))
    step = max(1, EXACT // max(1, most * most))
    if most * most < EXACT:  # products of floats are exact in so many rows
        total = [0] * len(upper[0])
        for a in range(0, len(y), step):
            f = y[a : a + step].astype(np.float64)
            total = [t + int(v) for t, v in zip(total, (f.T @ f)[upper], strict=True)]
    else:
        big = y.astype(object)
        total = (big.T @ big)[upper].tolist()
    return np.array([*y.sum(axis=0, dtype=object).tolist(), *total], dtype=object)


def covariance(n: int, dims: int, sums: list[int]) -> np.ndarray:
    """From exact sums of y and of products of y (upper triangle): covariance with divisor n, each entry rounded once."""
    first, products = sums[:dims], sums[dims:]
    out = np.zeros((dims, dims))
    for i, j, p in zip(*np.triu_indices(dims), products, strict=True):
        out[i, j] = out[j, i] = float(Fraction(n * p - first[i] * first[j], n * n))
    return out


def jacobi(symmetric: np.ndarray, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) by cyclic Jacobi rotations.

    A rotation makes one pair of entries off the diagonal vanish; a sweep takes all pairs in turn. It ends with a sweep
    in which every such entry is below half a rounding unit of the geometric mean of its two diagonal entries.
    """
    a = np.array(symmetric, dtype=np.float64)
    d = len(a)
    v = np.eye(d)
    tiny = np.finfo(np.float64).eps / 2
    floor = np.finfo(np.float64).tiny
    for _ in range(sweeps):
        turned = False
        for p in range(d - 1):
            for q in range(p + 1, d):
                off = a[p, q]
                if abs(off) <= max(tiny * np.sqrt(abs(a[p, p]) * abs(a[q, q])), floor):
                    continue
                turned = True
                theta = (a[q, q] - a[p, p]) / (2 * off)
                t = (1.0 if theta >= 0 else -1.0) / (abs(theta) + np.hypot(theta, 1.0))
                c = 1 / np.hypot(t, 1.0)
                s = t * c
                row_p, row_q = a[p].copy(), a[q].copy()
                a[p], a[q] = c * row_p - s * row_q, s * row_p + c * row_q
                col_p, col_q = a[:, p].copy(), a[:, q].copy()
                a[:, p], a[:, q] = c * col_p - s * col_q, s * col_p + c * col_q
                a[p, q] = a[q, p] = 0.0
                v_p, v_q = v[:, p].copy(), v[:, q].copy()
                v[:, p], v[:, q] = c * v_p - s * v_q, s * v_p + c * v_q
        if not turned:
            break
    values = np.diag(a).copy()
    order = np.argsort(-values, kind="stable")
    vectors = v[:, order] / np.linalg.norm(v[:, order], axis=0)
    lead = vectors[np.abs(vectors).argmax(axis=0), np.arange(d)]
    return values[order], vectors * np.where(lead < 0, -1.0, 1.0)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, as int64 where all squares of a row fit into 64 bits, else as Python integers."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most * most * x.shape[1] < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def projected(off: np.ndarray, n: int, matrix: np.ndarray) -> np.ndarray:
    """Rows times the whitening matrix, dimension by dimension, so that equal rows have equal results in any batch."""
    out = np.zeros((len(off), matrix.shape[1]))
    for j in range(off.shape[1]):
        out += (off[:, j] / n).astype(np.float64)[:, None] * matrix[j]
    return out


class Whitening:
    """Mean, eigenvalues and whitening matrix of a table's distinct vectors (x: array of longs)."""

    def __init__(self, rows: DataFrame, components: int | None = COMPONENTS):
        self._fit = Stored(rows.select("x").distinct(), "distinct_vectors")
        sizes = self._fit.df.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
        if sizes.least != sizes.most:
            raise ValueError(f"vectors have {sizes.least} to {sizes.most} entries")
        self.n, self.dims = sizes.n, sizes.most or 0
        self.sums, self.matrix, self.explained, self.eigenvalues = [], np.zeros((0, 0)), np.zeros(0), np.zeros(0)
        if not self.dims:
            return
        dims = self.dims
        self.sums = summed(self._fit.df, dims, lambda x: x.sum(axis=0, dtype=object))
        centre = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)
        self.covariance = covariance(self.n, dims, summed(self._fit.df, dims, lambda x: scatter(x, centre)))
        values, vectors = jacobi(self.covariance)
        trace = float(np.trace(self.covariance))
        some = values > dims * np.finfo(np.float64).eps * trace
        some[components:] = False
        self.eigenvalues = values[some]
        self.matrix = vectors[:, some] / np.sqrt(self.eigenvalues)
        self.explained = self.eigenvalues / trace if trace else self.eigenvalues

    def identity_error(self) -> float:
        """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on its rows."""
        n, dims, sums, matrix = self.n, self.dims, self.sums, self.matrix
        k = matrix.shape[1]
        if not k:
            return 0.0
        upper = np.triu_indices(k)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(k + len(upper[0]))
            for batch in batches:
                if batch.num_rows:
                    z = projected(deviations(matrix_of(batch.column("x"), dims), n, sums), n, matrix)
                    total += np.concatenate([z.sum(axis=0), (z.T @ z)[upper]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "v"])

        got = self._fit.df.select("x").mapInArrow(run, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
        total = np.array([r.v for r in sorted(got, key=lambda r: r["at"])]) / n
        mean, second = total[:k], np.zeros((k, k))
        second[upper] = total[k:]
        return float(np.abs(np.triu(second - np.outer(mean, mean) - np.eye(k))).max())

    def apply(self, rows: DataFrame, id_col: str) -> DataFrame:
        """Per row (id_col, x): deviation and whitened (array, a component each). Narrow."""
        n, dims, sums, matrix = self.n, self.dims, self.sums, self.matrix
        kind = rows.schema[id_col].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    off = deviations(matrix_of(batch.column("x"), dims), n, sums)
                    z = projected(off, n, matrix)
                    lists = pa.ListArray.from_arrays(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1], z.reshape(-1))
                    yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array((off * off).sum(axis=1).tolist(), pa.int64()), lists], ["id", "deviation", "whitened"])

        plain = rows.select(F.col(id_col).alias("id"), "x")
        return plain.mapInArrow(run, f"id {kind}, deviation bigint, whitened array<double>").withColumnRenamed("id", id_col)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, components: int | None = COMPONENTS) -> tuple[DataFrame, Whitening]:
    """(id, deviation, whitened) of each usable row, and what was fitted; components: so many at most, None for all."""
    rows = vectors.where(usable(vector_col)).select(F.col(id_col), whole_entries(vector_col, scale).alias("x"))
    fitted = Whitening(rows, components)
    return fitted.apply(rows, id_col), fitted


def op12_jacobi_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable embeddings, a row for each of up to four components."""
    out, fitted = whiten(table(spark, sf_dir, "embeddings"))
    explained = F.array(*map(F.lit, fitted.explained.tolist())).cast("array<double>")
    return out.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(fitted.identity_error()).alias("identity_error"),
    )
