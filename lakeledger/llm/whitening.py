"""Whitening of embeddings along their leading principal components.

Entries are fixed-point numbers, x = floor(256 * c), so sums and the covariance V of the
fit list (each distinct x vector once) are exact integers: tasks add up the entries, then
the products of entries centred by the rounded mean, and the driver divides once. Only
dims x dims numbers reach the driver.

V's eigenvectors come in mixed precision: float32 LAPACK gives the first guess, and the
matrix-multiplication iterations of Ogita and Aishima correct it in extended precision
(numpy's longdouble): with R = I - X'X and S = X'VX, the update X + XE has
E_ij = (S_ij + e_j R_ij) / (e_j - e_i), which doubles the right digits in a round.
Eigenvalues closer than the residual can tell apart form a cluster; the cluster's own small
problem X_J'(V - mu I)X_J, where the common part is gone, is solved by itself and rotates
its columns; later rounds then see the gaps inside.

Cost: one shuffle of the distinct vectors, written once; two passes over them for the sums
and the products, one that measures the whitened covariance, and a pass over the table.

Edge cases: rows whose vector is null or holds a null or non-finite entry go. Zero vectors,
repeated ids and null ids stay. Vectors of another length are another fit (n, deviation and
components are those of the length); an empty vector has no component and no row. Entries
beyond a long saturate. A component without variance (one distinct vector, constant
dimensions) has a null ``whitened``, no variance at all a null ``explained``; such
components don't count in ``identity_error``, which is null if none is left. A deviation
beyond a long is null. An empty table gives no rows. Columns named like an output column
are replaced; others stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.llm.common import by_place, col, others, small_batches, staged

SCALE = 256
ROUNDS = 12  # of the refinement at most; each doubles the right digits, a cluster costs one more
WIDE = np.longdouble
LIMB = 62  # sums beyond 62 bits travel in parts
OUT = [T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
       T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
       T.StructField("identity_error", T.DoubleType())]


def usable(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def fixed_point(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))


# ------------------------------------------------------------------ eigenvectors


def clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Groups (two and more) of values whose neighbours are at most ``width`` apart."""
    order = np.argsort(values, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(values[order]) > width) + 1)
    return [p for p in parts if len(p) > 1]


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, both in
    extended precision."""
    dims = len(matrix)
    top = float(np.abs(matrix).max(initial=0.0))
    if top == 0.0:
        return np.zeros(dims, WIDE), np.eye(dims, dtype=WIDE)
    unit = WIDE(2.0) ** int(np.ceil(np.log2(top)))  # a power of two: scaling loses nothing
    a = matrix.astype(WIDE) / unit
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    one, size = np.eye(dims, dtype=WIDE), np.sqrt((a * a).sum())
    for _ in range(ROUNDS):
        r, s = one - x.T @ x, x.T @ a @ x
        e = np.diag(s) / (1 - np.diag(r))
        rest = s - np.diag(e)
        width = 2 * (np.sqrt((rest * rest).sum()) + size * np.sqrt((r * r).sum()))
        gap = e[None, :] - e[:, None]
        near = np.abs(gap) <= width
        step = np.where(near, r / 2, (s + e[None, :] * r) / np.where(near, 1, gap))
        x = x + x @ step
        for own in clusters(e, width):
            v = x[:, own]
            t = v.T @ (a @ v - e[own].mean() * v)
            if (most := np.abs(t).max()) > 0:
                x[:, own] = v @ np.linalg.eigh((t / most).astype(np.float64))[1].astype(WIDE)
        if np.abs(step).max() < 4 * np.finfo(WIDE).eps:
            break
    for _ in range(2):  # what tiny gaps left of the last step's square: back to orthonormal
        x = x @ (3 * one - x.T @ x) / 2
    e = (x * (a @ x)).sum(0)
    order = np.argsort(-e, kind="stable")
    return e[order] * unit, x[:, order]


# ------------------------------------------------------------------ exact sums


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dims, row numbers, matrix) of a batch of vectors, for each length."""
    lengths = column.value_lengths().to_numpy()
    for dims in np.unique(lengths):
        at = np.flatnonzero(lengths == dims)
        yield int(dims), at, column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), int(dims))


def largest(m: np.ndarray) -> int:
    return max(int(m.max()), -int(m.min())) if m.size else 0


def whole(m: np.ndarray, times: int, less) -> np.ndarray:
    """times * m - less, exactly: in 64 bits, or in Python's integers where those don't do."""
    less = np.array(less, dtype=object)
    if times * largest(m) + largest(less) < 1 << LIMB:
        return m * np.int64(times) - less.astype(np.int64)
    return m.astype(object) * times - less


def products(y: np.ndarray) -> np.ndarray:
    """Y'Y as integers: float64 matrix products of blocks whose sums stay below 2**53."""
    top, dims = largest(y), y.shape[1]
    total = np.zeros((dims, dims), object)
    if top >= 1 << 26:
        return total + y.astype(object).T @ y.astype(object)
    rows = max(1, (1 << 53) // max(1, top * top))
    for at in range(0, len(y), rows):
        part = y[at:at + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def summed(vectors: DataFrame, part: Callable[[int, np.ndarray], np.ndarray]) -> dict[int, dict[tuple[int, int], int]]:
    """For each length, the sums over all rows of the integer matrix that ``part`` makes of
    (dims, rows): a task adds up its own, the rest is a grouped sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, _, rows in by_length(batch.column(0)):
                sums[dims] = sums.get(dims, 0) + part(dims, rows)
        for dims, total in sums.items():
            i, j = (a.ravel() for a in np.indices(total.shape))
            left, limb = total.ravel(), 0
            while limb == 0 or left.any():
                sign = np.where(left < 0, -1, 1)
                low = (left * sign) % (1 << LIMB) * sign
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), dims, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                     pa.array(np.full(len(i), limb, np.int32)), pa.array(low.astype(np.int64))], names=["dims", "i", "j", "limb", "v"])
                left, limb = (left - low) // (1 << LIMB), limb + 1

    found: dict[int, dict[tuple[int, int], int]] = {}
    added = (vectors.mapInArrow(run, "dims int, i int, j int, limb int, v long").groupBy("dims", "i", "j", "limb")
             .agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v")))
    for row in added.collect():  # dims * dims numbers for each length
        own = found.setdefault(row.dims, {})
        own[row.i, row.j] = own.get((row.i, row.j), 0) + (int(row.v) << (LIMB * row.limb))
    return found


# ------------------------------------------------------------------ the operator


@dataclass
class Fit:
    """What is known of the vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray  # the leading eigenvalues, falling
    vectors: np.ndarray  # (dims, components)
    explained: np.ndarray
    identity_error: float | None = None

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        """Rows of n * x - S, whitened; NaN along a component without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return centred.astype(np.float64) @ self.vectors / self.n / np.sqrt(np.where(self.values > 0, self.values, np.nan))


def wide(x: Fraction) -> np.longdouble:
    high = float(x)
    return WIDE(high) + WIDE(float(x - Fraction(high)))


def fit(vectors: DataFrame, components: int = 4) -> dict[int, Fit]:
    """A fit for each length, from distinct fixed-point vectors (the only column)."""
    first = summed(vectors, lambda dims, x: np.vstack([x.astype(object).sum(0, keepdims=True), np.full((1, dims), len(x), object)]))
    n = {dims: own[1, 0] for dims, own in first.items() if dims}
    sums = {dims: [own[0, i] for i in range(dims)] for dims, own in first.items() if dims}
    centre = {dims: [(2 * s + n[dims]) // (2 * n[dims]) for s in own] for dims, own in sums.items()}
    second = summed(vectors, lambda dims, x: products(whole(x, 1, centre[dims])) if dims else np.zeros((0, 0), object))
    fits = {}
    for dims, count in n.items():
        shift = [s - count * c for s, c in zip(sums[dims], centre[dims])]
        v = np.zeros((dims, dims), WIDE)
        for (i, j), total in second[dims].items():
            if i <= j:
                v[i, j] = v[j, i] = wide(Fraction(count * total - shift[i] * shift[j], count * count))
        values, x = eigen(v)
        trace = np.trace(v)
        top = np.where(values > dims * trace * WIDE(2.0) ** -60, values, 0)[:components]
        explained = top / trace if trace > 0 else np.full(len(top), np.nan)
        fits[dims] = Fit(count, sums[dims], top.astype(np.float64), x[:, :components].astype(np.float64), explained.astype(np.float64))
    for dims, error in measured(vectors, fits).items():
        fits[dims].identity_error = error
    return fits


def measured(vectors: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """The largest absolute entry of the whitened vectors' covariance minus the identity,
    from the whitened vectors themselves (whose mean is 0 by construction)."""
    shared = vectors.sparkSession.sparkContext.broadcast(fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, _, x in by_length(batch.column(0)):
                if dims:
                    own = shared.value[dims]
                    w = own.whiten(whole(x, own.n, own.sums))
                    sums[dims] = sums.get(dims, 0.0) + w.T @ w
        for dims, total in sums.items():
            i, j = (a.ravel() for a in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), dims, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(total.ravel())], names=["dims", "i", "j", "v"])

    worst: dict[int, float] = {}
    for row in vectors.mapInArrow(run, "dims int, i int, j int, v double").groupBy("dims", "i", "j").agg(F.sum("v").alias("v")).collect():
        error = abs(row.v / fits[row.dims].n - (row.i == row.j))
        if error == error:  # a component without variance has none
            worst[row.dims] = max(worst.get(row.dims, 0.0), error)
    return worst


def whiten(df: DataFrame, *, components: int = 4, vector: str = "embedding") -> DataFrame:
    """For each usable row and each of its leading components: the row's other columns,
    component (from 1), n, deviation, whitened, explained and identity_error."""
    keep = others(df, [vector, *(f.name for f in OUT)])
    rows = df.where(usable(col(vector))).select(*[col(c) for c in keep], fixed_point(col(vector)).alias("__x"))
    fits = fit(staged(rows.select("__x").distinct(), "whitening-vectors"), components)
    shared = df.sparkSession.sparkContext.broadcast(fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1024):
            for dims, at, x in by_length(batch.column(batch.num_columns - 1)):
                if not dims:
                    continue
                own = shared.value[dims]
                centred = whole(x, own.n, own.sums)
                k, exact = len(own.values), centred if dims * largest(centred) ** 2 < 1 << 63 else centred.astype(object)
                far = [int(v) if v < 1 << 63 else None for v in (exact * exact).sum(1)]
                index = np.repeat(at, k)
                white = own.whiten(centred).ravel()
                explained = np.tile(own.explained, len(at))
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(index)) for c in batch.columns[:-1]), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                     pa.array(np.full(len(index), own.n, np.int64)), pa.array([v for v in far for _ in range(k)], pa.int64()),
                     pa.array(white, mask=np.isnan(white)), pa.array(explained, mask=np.isnan(explained)),
                     pa.array([own.identity_error] * len(index), pa.float64())], names=[*keep, *(f.name for f in OUT)])

    return by_place(rows).mapInArrow(run, T.StructType([*(df.schema[c] for c in keep), *OUT]))
