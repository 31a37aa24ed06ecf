"""Whitening of vectors by the leading eigenvectors of their covariance.

1. Components become integers, floor(scale * component) + shift. Tasks add up their vectors; Spark adds up the tasks.
2. Tasks subtract the means and multiply: their parts of the covariance are summed by Spark, entry by entry.
3. The matrix, as large as the vectors are long, is worked on by the driver: Householder reflections make it tridiagonal,
   Sturm counts bisect for the leading eigenvalues, inverse iteration finds their vectors, those of near eigenvalues are
   orthogonalised against each other, and the reflections are undone.
4. The components go to all tasks, which project every vector. Spark's own covariance of the result gives its distance from
   the identity.

Defined results: vectors that are null, or hold a null or non-finite entry, are dropped. Shorter vectors count as ending in
zero entries. A component whose eigenvalue is zero to rounding (a constant table, a single row, more components than ranks)
has nothing to scale by: whitened is 0 and explained the share, 0 if there is no variance at all. A deviation beyond 64 bits
is null. Rows that repeat count and come back as often as they occur; a null id stays null; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import named, staged
from ontime.llm.vafile import _dense, finite

#: Eigenvalues closer than this share of the matrix's size are handled as one cluster.
NEAR = 1e-3
ROUNDS = 5


# --- a symmetric matrix's leading eigenvectors -----------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder reflections that lead there; the matrix must be symmetric."""
    a = matrix.astype(np.float64).copy()
    n = len(a)
    mirrors = []
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        x[0] += np.copysign(size, x[0])
        length = np.linalg.norm(x)
        v = x / length if length else x  # a column that is zero already needs no mirror
        mirrors.append(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = 2.0 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1, k] = a[k, k + 1] = -np.copysign(size, a[k + 1, k])
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues lie below each point."""
    least = np.finfo(np.float64).tiny / np.finfo(np.float64).eps + np.finfo(np.float64).eps ** 2 * (np.abs(off).max(initial=0) + np.abs(diagonal).max(initial=0))
    counts = np.zeros(at.shape, np.int64)
    pivot = np.ones(at.shape)
    for i, d in enumerate(diagonal):
        pivot = d - at - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        counts += pivot < 0
    return counts


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, largest first, by bisection to the last bit."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low, high = np.full(count, (diagonal - reach).min()), np.full(count, (diagonal + reach).max())
    margin = np.finfo(np.float64).eps * n * max(np.abs(low[0]), np.abs(high[0]), np.finfo(np.float64).tiny)
    low, high = low - margin, high + margin
    wanted = n - 1 - np.arange(count)  # so many eigenvalues lie below the one in question
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        upper = below(diagonal, off, middle) <= wanted
        low, high = np.where(upper, middle, low), np.where(upper, high, middle)


def _solve(diagonal: np.ndarray, off: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """A tridiagonal system by elimination with row exchanges; pivots are kept at ``least``."""
    n = len(diagonal)
    d, u, v, x = diagonal.copy(), np.append(off, 0.0), np.zeros(n), b.copy()  # diagonal, first and second above it
    for i in range(n - 1):
        lower, dn, un = off[i], d[i + 1], u[i + 1]
        if abs(lower) > abs(d[i]):
            f = d[i] / lower
            d[i], d[i + 1], u[i + 1] = lower, u[i] - f * dn, -f * un
            u[i], v[i] = dn, un
            x[i], x[i + 1] = x[i + 1], x[i] - f * x[i + 1]
        else:
            d[i] = d[i] if abs(d[i]) >= least else least
            f = lower / d[i]
            d[i + 1], x[i + 1] = dn - f * u[i], x[i + 1] - f * x[i]
    for i in range(n - 1, -1, -1):
        pivot = d[i] if abs(d[i]) >= least else least
        x[i] = (x[i] - (u[i] * x[i + 1] if i + 1 < n else 0.0) - (v[i] * x[i + 2] if i + 2 < n else 0.0)) / pivot
    return x


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of the tridiagonal matrix by inverse iteration; near ones are kept orthogonal."""
    n = len(diagonal)
    size = max(np.abs(diagonal).max(initial=0) + 2 * np.abs(off).max(initial=0), np.finfo(np.float64).tiny)
    least = np.finfo(np.float64).eps * size
    draw = np.random.default_rng(0)
    found = np.zeros((len(values), n))
    cluster = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > NEAR * size:
            cluster = k
        shift = value - (k - cluster) * least  # equal values get shifts of their own
        x = draw.standard_normal(n)
        for _ in range(ROUNDS):
            for _ in range(2):  # once more: the first pass leaves what rounding lost
                x -= found[cluster:k].T @ (found[cluster:k] @ x)
            x = _solve(diagonal - shift, off, x / np.linalg.norm(x), least)
            x /= np.abs(x).max()
        for _ in range(2):
            x -= found[cluster:k].T @ (found[cluster:k] @ x)
        found[k] = x / np.linalg.norm(x)
    return found


def leading_eigen(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues and their unit eigenvectors (rows) of a symmetric matrix."""
    count, size = min(count, len(matrix)), np.abs(matrix).max(initial=0)
    if size == 0:
        return np.zeros(count), np.eye(count, len(matrix))
    diagonal, off, mirrors = tridiagonal(matrix / size)
    values = leading_values(diagonal, off, count)
    vectors = leading_vectors(diagonal, off, values)
    for k in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k]
        vectors[:, k + 1:] -= 2.0 * np.outer(vectors[:, k + 1:] @ v, v)
    return values * size, vectors


# --- the table -------------------------------------------------------------------------------------


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, total, n, most): sums of a task's vectors per dimension, rows that have the dimension, the largest size."""
    total, n, most = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(batch.column("x").offsets.to_numpy())
        width = max(int(sizes.max()), len(total))
        x = _dense(batch.column("x"), width)
        total, n, most = (np.concatenate([old, np.zeros(width - len(old), np.int64)]) for old in (total, n, most))
        total, n, most = total + x.sum(0), n + (sizes[:, None] > np.arange(width)).sum(0), np.maximum(most, np.abs(x).max(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total), pa.array(n), pa.array(most)], ["dim", "total", "n", "most"])


class Fit:
    """Count, sums, covariance and leading components of a table of integer vectors."""

    def __init__(self, rows: DataFrame, shift: int, components: int):
        self.shift = shift
        self.n = rows.count()
        per_dim = rows.select("x").mapInArrow(_sums, "dim int, total long, n long, most long").groupBy("dim").agg(
            F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("most").alias("most")).orderBy("dim").collect()
        self.sums = np.array([r.total + (self.n - r.n) * shift for r in per_dim], object)  # Python's integers: no bound
        self.most = max([abs(shift), *[r.most for r in per_dim]])
        self.means = np.array([s / self.n for s in self.sums], np.float64) if self.n else np.zeros(0)
        self.trace, self.values, self.vectors = 0.0, np.zeros(0), np.zeros((0, len(self.means)))
        if len(self.means):
            covariance = self._covariance(rows)
            self.trace = float(np.trace(covariance))
            self.values, self.vectors = leading_eigen(covariance, components)
        floor = len(self.means) * np.finfo(np.float64).eps * self.values[0] if len(self.values) else 0.0
        self.usable = self.values > max(floor, 0.0)

    def _covariance(self, rows: DataFrame) -> np.ndarray:
        width, dense = len(self.means), self.dense
        means = self.means

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros((width, width))
            for batch in batches:
                centred = dense(batch.column("x")) - means
                own += centred.T @ centred
            i, j = np.triu_indices(width)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(own[i, j])], ["i", "j", "v"])

        out = np.zeros((width, width))
        for i, j, v in rows.select("x").mapInArrow(parts, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect():
            out[i, j] = out[j, i] = v / self.n
        return out

    @property
    def dense(self):
        """Vectors as rows of a matrix; what is missing behind shorter ones is a zero entry, which becomes ``shift``."""
        width, shift = len(self.means), self.shift

        def filled(column: pa.Array) -> np.ndarray:
            x = _dense(column, width)
            sizes = np.diff(column.offsets.to_numpy())
            return x if (sizes == width).all() else np.where(sizes[:, None] > np.arange(width), x, shift)

        return filled


def _project(fit: Fit):
    """(vec_id, deviation, whitened) of each vector."""
    n, dense, means, sums, shift = fit.n, fit.dense, fit.means, fit.sums, fit.shift
    scaled = np.where(fit.usable, 1.0, 0.0)[:, None] * fit.vectors / np.sqrt(np.where(fit.usable, fit.values, 1.0))[:, None]
    # n * x - S is taken from small numbers: (x - shift) * n - (S - n * shift)
    rest = np.array([s - n * shift for s in sums], object)
    reach = (fit.most + abs(shift)) * n + max([abs(r) for r in rest], default=0)
    small = reach ** 2 * max(len(sums), 1) < 1 << 63

    def deviations(x: np.ndarray) -> list[int | None]:
        if small:
            own = (x - shift) * n - rest.astype(np.int64)
            return (own * own).sum(1).tolist()
        own = (x.astype(object) - shift) * n - rest
        return [d if d < 1 << 63 else None for d in (own * own).sum(1).tolist()] if own.shape[1] else [0] * len(own)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = dense(batch.column("x"))
            whitened = (x - means) @ scaled.T
            offsets = np.arange(len(x) + 1, dtype=np.int32) * whitened.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviations(x), pa.int64()), pa.ListArray.from_arrays(offsets, whitened.reshape(-1))],
                ["vec_id", "deviation", "whitened"])

    return projected


def identity_error(projected: DataFrame, components: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    if not pairs:
        return 0.0
    w = F.col("whitened")
    row = projected.agg(*[F.covar_pop(w[i], w[j]).alias(f"c_{i}_{j}") for i, j in pairs]).first()
    return max(abs((row[f"c_{i}_{j}"] or 0.0) - (i == j)) for i, j in pairs)


def integers(vector: Column, scale: float, shift: int) -> Column:
    return F.transform(vector, lambda c: F.coalesce(F.try_add(F.floor(c * F.lit(scale)), F.lit(shift).cast("long")), F.floor(c)))


def whiten(vectors: DataFrame, components: int = 8, scale: float = 1024.0, shift: int = 100_000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row per remaining row and component."""
    vector = named(vector_col).cast("array<double>")
    rows = staged(vectors.where(finite(vector)).select(named(id_col).cast("long").alias("vec_id"), integers(vector, scale, shift).alias("x")), "whiten-rows")
    fit = Fit(rows, shift, components)
    projected = staged(rows.mapInArrow(_project(fit), "vec_id long, deviation long, whitened array<double>"), "whitened")
    error = identity_error(projected, len(fit.values))
    shares = [float(v / fit.trace) if fit.trace > 0 else 0.0 for v in fit.values]
    share = F.element_at(F.array(*map(F.lit, shares)), F.col("component")) if shares else F.lit(0.0)
    each = projected.select("vec_id", F.posexplode("whitened").alias("place", "whitened"), "deviation")
    return each.withColumn("component", F.col("place") + 1).select(
        "vec_id", "component", F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"),
        F.lit(error).alias("identity_error"))
