"""Operator 11: whitening of embeddings along the principal components of their covariance.

Entries become integers ``x = floor(64 * c) + 1000000``.  Three passes over the rows, each an
aggregate of what a task has seen, so only sums per dimension and matrices of dimension times
dimension (never rows) meet:

1. n and the exact sums S per dimension.
2. V, the covariance of x: rows are centred by S / n before they are multiplied.
3. After whitening, its own covariance, from means and centred products per task.

V is taken apart by spectral divide and conquer (Nakatsukasa and Higham, 2013): the unitary
polar factor U of ``V - s I`` is its matrix sign, by QDWH iterations (dynamically weighted
Halley steps in QR form, whatever the condition), so ``(I + U) / 2`` projects on the invariant
subspace of the eigenvalues above s.  An orthonormal basis of either subspace turns V into
two smaller blocks, and each is split again until single components or blocks whose
eigenvalues agree to rounding remain.  The 32 directions are broadcast and applied to rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
#: Entries from 2**45 on have no exact integer x in a double; such rows are left out.
LARGEST = float(1 << 45)
#: Partial matrices of tasks are first summed in so many groups per matrix row.
FAN_IN = 32


# ---------------------------------------------------------------- spectral divide and conquer
def polar(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a square matrix (the sign of a symmetric one), by QDWH.

    A singular direction has no sign; rounding gives it one.
    """
    n = len(a)
    alpha = np.sqrt(np.abs(a).sum(axis=0).max() * np.abs(a).sum(axis=1).max())  # at least the 2-norm
    if alpha == 0:
        return np.eye(n)
    x, low, eye = a / alpha, np.finfo(float).eps / 4, np.eye(n)
    for _ in range(40):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2)) if low < 1 else 0.0
        b0 = math.sqrt(1 + d)
        a0 = b0 + 0.5 * math.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * b0))
        b = (a0 - 1) ** 2 / 4
        c = a0 + b - 1
        q, _ = np.linalg.qr(np.vstack([math.sqrt(c) * x, eye]))
        new = (b / c) * x + (a0 - b / c) / math.sqrt(c) * (q[:n] @ q[n:].T)
        low = min(1.0, low * (a0 + b * l2) / (1 + c * l2))
        moved, x = np.abs(new - x).max(), new
        if moved < 1e-14 and 1 - low < 1e-14:
            break
    return x


def _basis(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range and the null space of a projector of known rank.

    Subspace iteration from fixed random vectors: the projector's values are 0 and 1.
    """
    n = len(projector)
    start = np.random.default_rng(n * 1009 + rank).standard_normal((n, n))
    q, _ = np.linalg.qr(np.hstack([projector @ start[:, :rank], start[:, rank:] - projector @ start[:, rank:]]))
    keep, drop = q[:, :rank], q[:, rank:]
    for _ in range(2):
        keep, _ = np.linalg.qr(projector @ keep)
        drop = drop - projector @ drop
        drop, _ = np.linalg.qr(drop - keep @ (keep.T @ drop))
    return keep, drop


def _shifts(d: np.ndarray) -> Iterator[float]:
    """Candidate shifts: the median of the diagonal, its widest gap, the means between."""
    d = np.sort(d)
    yield float(np.median(d))
    gap = int(np.argmax(np.diff(d)))
    yield float((d[gap] + d[gap + 1]) / 2)
    yield float(d.mean())
    for k in range(1, 8):
        yield float(d[0] + (d[-1] - d[0]) * k / 8)


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix."""
    n = len(v)
    scale = np.abs(v).max() if n else 0.0
    values, vectors = np.zeros(n), np.zeros((n, n))
    todo, at = [(v, np.eye(n))], 0
    while todo:
        a, basis = todo.pop()
        m = len(a)
        a = (a + a.T) / 2
        off = np.abs(a - np.diag(np.diag(a))).max() if m > 1 else 0.0
        if off <= 1e-15 * scale:  # diagonal: its entries are the eigenvalues
            values[at : at + m], vectors[:, at : at + m] = np.diag(a), basis
            at += m
            continue
        for shift in _shifts(np.diag(a)):
            u = polar(a - shift * np.eye(m))
            projector = (np.eye(m) + (u + u.T) / 2) / 2
            rank = int(round(np.trace(projector)))
            if 0 < rank < m and np.abs(projector @ projector - projector).max() < 1e-6:
                high, low = _basis(projector, rank)
                if np.abs(high.T @ a @ low).max() <= 1e-13 * scale:
                    break
        else:
            # No shift parts them: a turn in the plane of the largest entry off the diagonal
            # (Jacobi) changes the diagonal, and the block is tried again.
            p, q = np.unravel_index(np.abs(np.triu(a, 1)).argmax(), a.shape)
            angle = 0.5 * math.atan2(2 * a[p, q], a[p, p] - a[q, q])
            turn = np.eye(m)
            turn[[p, q], [p, q]] = math.cos(angle)
            turn[p, q], turn[q, p] = -math.sin(angle), math.sin(angle)
            todo.append((turn.T @ a @ turn, basis @ turn))
            continue
        todo += [(low.T @ a @ low, basis @ low), (high.T @ a @ high, basis @ high)]
    vectors, _ = np.linalg.qr(vectors) if n else (vectors, None)  # what rounding of many products lost
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ---------------------------------------------------------------- passes over the rows
def usable(embedding: Column) -> Column:
    """Vectors without null, non-finite or (beyond doubles' integers) too large entries."""
    fine = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return F.coalesce(fine & (F.size(embedding) > 0), F.lit(False))


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    """x - SHIFT of every row, as whole doubles."""
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))


def _adder(keys: list[str]):
    def add(batch: pa.Table) -> pa.Table:
        out = {k: batch.column(k).slice(0, 1).combine_chunks() for k in keys}
        total = 0.0
        for values in batch.column("values").chunks:
            if len(values):
                total = total + values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1).sum(axis=0)
        return pa.table(out | {"values": pa.array([total.tolist()], type=pa.list_(pa.float64()))})

    return add


def _added(parts: DataFrame) -> DataFrame:
    """Sums of the arrays ``values`` by ``i``: first within FAN_IN groups of tasks, then over those."""
    parts = parts.withColumn("group", F.pmod(F.xxhash64("task"), F.lit(FAN_IN)))
    parts = parts.groupBy("i", "group").applyInArrow(_adder(["i", "group"]), "i int, group long, values array<double>")
    return parts.groupBy("i").applyInArrow(_adder(["i"]), "i int, values array<double>")


def _matrix(parts: DataFrame, dim: int) -> np.ndarray:
    out = np.zeros((dim, dim))
    for r in _added(parts).collect():  # one row per dimension
        out[r["i"]] = r["values"]
    return out


def sums(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """n and the exact sum of x - SHIFT per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            x = _integers(batch.column(0), dim)
            n += len(x)
            step = 1 if not x.size else max(1, int(2**62 // max(1.0, np.abs(x).max())))
            for at in range(0, len(x), step):  # sums within 64 bits
                total = [a + b for a, b in zip(total, x[at : at + step].astype(np.int64).sum(axis=0).tolist())]
        if n:
            out = [range(-1, dim), [Decimal(n), *map(Decimal, total)]]
            yield pa.record_batch([pa.array(out[0], type=pa.int32()), pa.array(out[1], type=pa.decimal128(38, 0))], names=["i", "s"])

    added = {r["i"]: int(r["s"]) for r in rows.select("vec").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    return added.get(-1, 0), [added.get(i, 0) for i in range(dim)]


def covariance(rows: DataFrame, dim: int, n: int, mean: np.ndarray) -> np.ndarray:
    """Of x over all rows, divisor n; a row is centred before it is multiplied."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((dim, dim))
        for batch in batches:
            y = _integers(batch.column(0), dim) - mean
            total += y.T @ y
        task = TaskContext.get().partitionId()
        columns = [pa.array([task] * dim, type=pa.int32()), pa.array(range(dim), type=pa.int32()), pa.array(total.tolist(), type=pa.list_(pa.float64()))]
        yield pa.record_batch(columns, names=["task", "i", "values"])

    return _matrix(rows.select("vec").mapInArrow(run, "task int, i int, values array<double>"), dim) / n


def identity_error(rows: DataFrame, dim: int, n: int, mean: np.ndarray, project: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity.

    Tasks give their count, mean and products centred by their own mean; a shift of mean
    between tasks is added as its own product (pairwise updates of Chan et al.).
    """
    k = project.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        count, centre, moment = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if not batch.num_rows:
                continue
            w = (_integers(batch.column(0), dim) - mean) @ project
            own = w.mean(axis=0)
            d, both = own - centre, count + len(w)
            moment += (w - own).T @ (w - own) + np.outer(d, d) * (count * len(w) / both)
            centre, count = centre + d * (len(w) / both), both
        if count:
            # About the common mean, which is zero up to rounding: products of the centres
            # and their weighted sum come along, and the latter is taken off at the end.
            full = np.vstack([moment + count * np.outer(centre, centre), count * centre])
            task = TaskContext.get().partitionId()
            columns = [pa.array([task] * (k + 1), type=pa.int32()), pa.array(range(k + 1), type=pa.int32()), pa.array(full.tolist(), type=pa.list_(pa.float64()))]
            yield pa.record_batch(columns, names=["task", "i", "values"])

    parts = _added(rows.select("vec").mapInArrow(run, "task int, i int, values array<double>"))
    full = np.zeros((k + 1, k))
    for r in parts.collect():  # k + 1 rows
        full[r["i"]] = r["values"]
    centre = full[k] / n
    return float(np.abs(full[:k] / n - np.outer(centre, centre) - np.eye(k)).max())


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: sums about SHIFT, eigenvalues and directions of the kept components."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums])

    @property
    def project(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, dim: int, components: int = 32) -> Whitening:
    """``rows`` has ``vec``, usable and of dimension ``dim``."""
    n, total = sums(rows, dim)
    fitted = Whitening(n, tuple(total), np.zeros(0), np.zeros((dim, 0)), 0.0)
    v = covariance(rows, dim, n, fitted.mean)
    values, vectors = eigen(v)
    # Directions in which the rows do not differ (beyond rounding) cannot be scaled to 1.
    kept = int((values > 1e-11 * max(values[0], 0.0)).sum()) if dim else 0
    kept = min(kept, components)
    return Whitening(n, tuple(total), values[:kept], vectors[:, :kept], float(np.trace(v)))


def whiten(rows: DataFrame, components: int = 32) -> DataFrame:
    """A row per vector and component (from 1, by falling eigenvalue, up to ``components``):
    vec_id, component, n, deviation, whitened, explained, identity_error.

    ``rows`` has vec_id and embedding.  Null vectors, empty ones and those with null or
    non-finite entries (or of 2**45 and more) are dropped, and so are vectors whose
    dimension is not the most common one (the smaller one of equals).  ``deviation`` is
    exact, and null where it does not fit a long.  Components along which the rows do not
    differ are left out, so equal rows, a single row or an empty table give no rows.
    Repeated rows, equal and null vec_ids are rows like any other; other columns are ignored.
    """
    spark = rows.sparkSession
    base = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec")).filter(usable(F.col("vec")))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    dims = base.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], schema)
    dim = dims[0]["dim"]
    base = base.filter(F.size("vec") == dim)
    fitted = fit(base, dim, components)
    k, n, total = len(fitted.values), fitted.n, fitted.sums
    if not k:
        return spark.createDataFrame([], schema)
    mean, project = fitted.mean, fitted.project
    error = identity_error(base, dim, n, mean, project)
    explained = fitted.values / fitted.trace
    shared = spark.sparkContext.broadcast((mean, project))  # dimension x components

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, project = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                x = _integers(some.column(1), dim)
                w = (x - mean) @ project
                deviation = _deviation(x, n, total)
                r = len(x)
                columns = [
                    some.column(0).take(pa.array(np.repeat(np.arange(r), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)),
                    pa.array(np.full(r * k, n, dtype=np.int64)),
                    deviation.take(pa.array(np.repeat(np.arange(r), k))),
                    pa.array(w.ravel()),
                    pa.array(np.tile(explained, r)),
                    pa.array(np.full(r * k, error)),
                ]
                yield pa.record_batch(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return base.mapInArrow(run, schema)


def _deviation(x: np.ndarray, n: int, total: tuple[int, ...]) -> pa.Array:
    """Sum over dimensions of (n * x - S)^2, exactly; null beyond a long."""
    far = n * float(np.abs(x).max(initial=0.0)) + max(map(abs, total))
    if far * far * max(1, len(total)) < 2.0**62:
        d = n * x.astype(np.int64) - np.array(total, dtype=np.int64)
        return pa.array(np.einsum("ij,ij->i", d, d))
    whole = [sum((n * int(a) - s) ** 2 for a, s in zip(row, total)) for row in x.tolist()]
    return pa.array([v if v < 2**63 else None for v in whole], type=pa.int64())
