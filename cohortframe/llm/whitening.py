"""Whitening of embeddings by eigenvectors that are refined to double precision.

Entries become whole numbers (``floor(1024 c) + 100000``), so that sums over all rows are exact in any order. One pass
gives the sums, a second one the products of the centred entries: each task centres its rows by the whole number nearest
to the mean before it multiplies, blocks of rows are multiplied as doubles that hold the sums exactly, and Spark adds
the blocks' matrices entry by entry. The rest of the mean is taken off in whole numbers. The covariance is therefore
exact before it is rounded once.

Its eigenvectors are first found in float32. Each iteration of Ogita and Aishima then corrects them by four matrix
products in extended precision: from the defects of orthogonality (``R = I - X'X``) and of diagonality (``S = X'AX``) it
gets the correction ``X(I + E)`` with ``E_ij = (s_ij + l_j r_ij) / (l_j - l_i)``. Eigenvalues too near to each other
for that quotient form a cluster: its part of S, shifted by the cluster's mean, is solved for itself and the basis turned
accordingly, until the iteration can tell the eigenvalues apart or they are equal to working precision.

Nulls: rows whose vector is null, or holds a null or non-finite entry, or one that is beyond 2^40 in size, are left out.
Vectors must have one length: that of most rows (the smaller one on a tie); rows of another length are left out, and so
are empty vectors. Null and repeated ids and repeated vectors are rows like any other. A component without variance (fewer
rows than dimensions, equal rows) has a null ``whitened`` and does not count in ``identity_error``. ``deviation`` is null
where it exceeds 64 bits. Columns besides the named ones are ignored. An empty table gives an empty result.

Scale: no shuffle of vectors. Tasks send one matrix of the size dimensions x dimensions each into an aggregation; the
driver holds one such matrix, whose size does not depend on the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortframe.llm.base import query, read

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Largest entry: beyond, scaled entries and their products leave the exact range.
LARGEST = float(1 << 40)
#: Rows multiplied at a time, and the largest centred entry for which a block's sums are exact as doubles.
BLOCK = 1024
EXACT = 1 << 21
#: Iterations of the refinement; it has converged after four at most where eigenvalues are apart.
ROUNDS = 12


# --- eigenvectors -------------------------------------------------------------------------------------------------


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Indexes of eigenvalues that follow each other at no more than ``gap``, groups of two or more."""
    order = np.argsort(values, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(values[order]) > gap) + 1)
    return [np.sort(g) for g in groups if len(g) > 1]


def refine(a: np.ndarray, x: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the symmetric ``a`` from approximate eigenvectors ``x``, in ``a``'s precision."""
    wide = a.dtype.type
    x = x.astype(wide)
    eps, one = np.finfo(wide).eps, np.eye(len(a), dtype=wide)
    norm = np.abs(a).sum(0).max()
    last = np.inf
    for _ in range(rounds):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        # Rounding makes both a little lopsided, which near eigenvalues would magnify.
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diagonal(s) / (1 - np.diagonal(r))
        off = s - np.diag(values)
        # Frobenius norms bound the spectral ones.
        gap = 2 * (np.sqrt((off**2).sum()) + norm * np.sqrt((r**2).sum()))
        near = np.abs(values[None, :] - values[:, None]) <= gap
        apart = np.where(near, 1, values[None, :] - values[:, None])
        e = np.where(near, r / 2, (s + values[None, :] * r) / apart)
        x = x + x @ e
        turned = 0.0
        for c in _clusters(values, float(gap)):
            # A sub-solve within the cluster's space, of the part that is left after its mean is taken off.
            part, mean = x[:, c], values[c].mean()
            small = part.T @ (a @ part) - mean * (part.T @ part)
            size = np.abs(small).max()
            if size <= norm * eps * len(a):
                continue  # equal to working precision: any basis of the space will do
            _, turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))
            x[:, c] = part @ turn.astype(wide)
            turned = max(turned, float(size / norm))
        change = max(float(np.abs(e).max()), turned)
        if change <= 4 * eps or (change >= last / 2 and change <= 1e-16):
            break
        last = change
    x = x + x @ ((one - x.T @ x) / 2)
    s = x.T @ (a @ x)
    return np.diagonal(s) / (x * x).sum(0), x


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a covariance to double precision.

    The largest entry of each vector is positive.
    """
    size = np.abs(v).max() or 1.0
    _, x = np.linalg.eigh((v / size).astype(np.float32))
    values, x = refine((v / size).astype(np.longdouble), x)
    order = np.argsort(-values, kind="stable")
    values, x = values[order] * size, x[:, order]
    x = x / np.sqrt((x * x).sum(0))
    top = np.abs(x).argmax(0)
    x = x * np.sign(x[top, np.arange(len(top))])
    return values.astype(np.float64), x.astype(np.float64)


# --- passes over the rows -----------------------------------------------------------------------------------------


def _scaled(column: pa.Array, dims: int) -> np.ndarray:
    """The whole numbers of a batch of vectors of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat.reshape(-1, dims) * SCALE).astype(np.int64) + SHIFT


def _usable(rows: DataFrame) -> DataFrame:
    fine = F.forall("v", lambda c: F.coalesce((F.abs(c) <= LARGEST) & ~F.isnan(c), F.lit(False)))
    return rows.where(F.col("v").isNotNull() & fine)


def _products(y: np.ndarray) -> np.ndarray:
    """``y'y`` of whole numbers, exactly, as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), BLOCK):
        part = y[at : at + BLOCK]
        if np.abs(part).max() < EXACT:
            d = part.astype(np.float64)
            total += (d.T @ d).astype(np.int64).astype(object)
        else:
            d = part.astype(object)
            total += d.T @ d
    return total


def _summed(rows: DataFrame, width: int, of_batch: Callable[[pa.Array], np.ndarray], kind: str = "decimal(38,0)") -> list:
    """The sum over all batches of a vector of ``width`` numbers; tasks add up their own first."""
    exact = kind.startswith("decimal")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object if exact else np.float64)
        for batch in batches:
            if batch.num_rows:
                total = total + of_batch(batch.column(0))
        values = pa.array([str(t) for t in total.tolist()]) if exact else pa.array(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int64)), values], names=["pos", "part"])

    parts = rows.select("v").mapInArrow(run, f"pos bigint, part {'string' if exact else kind}")
    sums = parts.groupBy("pos").agg(F.sum(F.col("part").cast(kind)).alias("total"))
    out = [0] * width
    for r in sums.collect():
        out[r["pos"]] = int(r["total"]) if exact else r["total"]
    return out


@dataclass(frozen=True)
class Whitener:
    """What the fit found: count, sums, eigenvalues (falling) and eigenvectors, and the variance of all dimensions."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dims(self) -> int:
        return len(self.sums)

    @property
    def solid(self) -> np.ndarray:
        """Components that have variance beyond rounding."""
        return self.values > self.dims * np.finfo(np.float64).eps * max(self.values[0], 0.0)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exactly."""
        if len(x) and int(np.abs(x).max()) * self.n < 1 << 62 and int(np.abs(self.sums).max()) < 1 << 62:
            return x * np.int64(self.n) - self.sums.astype(np.int64)
        return x.astype(object) * self.n - self.sums

    def whiten(self, x: np.ndarray, components: int) -> np.ndarray:
        """Projections of the centred rows over the root of the eigenvalue; NaN without variance."""
        k = min(components, self.dims)
        centred = (self.deviations(x) / self.n).astype(np.float64)
        scale = np.where(self.solid[:k], np.sqrt(np.where(self.solid[:k], self.values[:k], 1.0)), np.nan)
        return centred @ self.vectors[:, :k] / scale


def fit(rows: DataFrame, dims: int) -> Whitener | None:
    """Exact moments of the vectors ``v`` of length ``dims``, and the eigenvectors of their covariance."""
    total = _summed(rows, dims + 1, lambda c: np.append(_scaled(c, dims).astype(object).sum(0), len(c)))
    n, sums = total[-1], np.array(total[:-1], object)
    if not n:
        return None
    centre = np.array([round(s / n) for s in sums], np.int64)
    upper = np.triu_indices(dims)
    found = _summed(rows, len(upper[0]), lambda c: _products(_scaled(c, dims) - centre)[upper])
    c = np.zeros((dims, dims), object)
    c[upper] = found
    c.T[upper] = found
    rest = sums - n * centre.astype(object)
    v = ((n * c - np.outer(rest, rest)) / (n * n)).astype(np.float64)
    values, vectors = eigen(v)
    return Whitener(n, sums, values, vectors, float(np.trace(v)))


def identity_error(rows: DataFrame, found: Whitener, components: int) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, over all rows."""
    k = int(found.solid[:components].sum())
    if not k:
        return None

    def of_batch(column: pa.Array) -> np.ndarray:
        w = found.whiten(_scaled(column, found.dims), components)[:, :k]
        return np.append((w.T @ w).ravel(), w.sum(0))

    total = np.array(_summed(rows, k * k + k, of_batch, "double"))
    mean = total[k * k :] / found.n
    cov = total[: k * k].reshape(k, k) / found.n - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable row of ``df`` and component: id, component, n, deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    rows = _usable(df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")))
    id_kind = rows.schema["id"].dataType.simpleString()
    out = f"{id_col} {id_kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    length = rows.groupBy(F.size("v").alias("dims")).count().where("dims > 0").orderBy(F.desc("count"), "dims").first()
    if length is None:
        return spark.createDataFrame([], out)
    dims = length["dims"]
    rows = rows.where(F.size("v") == dims)
    found = fit(rows, dims)
    error = identity_error(rows, found, components)
    k = min(components, dims)
    share = found.values[:k] / found.trace if found.trace > 0 else np.full(k, np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                x = _scaled(some.column(1), dims)
                off = found.deviations(x)
                if off.dtype != object and float((off.astype(np.float64) ** 2).sum(1).max()) < 2.0**62:
                    deviation = pa.array((off**2).sum(1))
                else:
                    exact = (off.astype(object) ** 2).sum(1)
                    deviation = pa.array([int(d) if d < 1 << 63 else None for d in exact], pa.int64())
                w = found.whiten(x, components)
                where = pa.array(np.repeat(np.arange(len(x)), k))
                whitened = pa.array(w.ravel(), mask=np.isnan(w).ravel())
                explained = np.tile(share, len(x))
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0).take(where), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(x) * k, found.n)), deviation.take(where), whitened,
                        pa.array(explained, mask=np.isnan(explained)), pa.array([error] * (len(x) * k), pa.float64()),
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, out)


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    """All embeddings with finite entries, eight components."""
    return whiten(read(spark, sf_dir, "embeddings"))
