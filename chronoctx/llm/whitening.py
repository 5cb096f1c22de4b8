"""Embedding whitening by a spectral divide and conquer.

Entries become integers, so counts, sums and the sums of products are exact in
doubles as long as they stay under 2^53 and do not depend on the order in which
tasks finish. Different vectors are counted once. Partitions send the sums of
their own rows; what reaches the driver is a matrix of the vectors' length
squared, never rows.

The covariance is split without an eigensolver. The polar factor of a shifted
symmetric matrix is its sign; a QDWH iteration (dynamically weighted Halley, by QR
while the weights are large, then by Cholesky) finds it in a few steps. Half of
sign plus identity projects onto the space of the eigenvalues above the shift; an
orthonormal basis of it and of its complement cut the matrix into two, which are
split on until one column is left or a part is a multiple of the identity.

Vectors that are null or hold null or non-finite entries are dropped. Shorter
vectors count as followed by zeros. Scaled entries are held within 2^52 on either
side. Components without variance cannot be whitened and are left out, so equal
rows alone, or a single row, give no rows; nor does an empty table. A deviation that a
long cannot hold is null. Ids may be null or repeated; each row is answered. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoctx.plans.session import store

SCALE, SHIFT, COMPONENTS = 64.0, 1_000_000, 16
#: Scaled entries beyond are held here; doubles have no fractions there.
FARTHEST = float(1 << 52)
#: Longs are summed in two halves of so many low bits, which cannot overflow.
LOW_BITS = 26
LONG = (1 << 63) - 1
EPS = np.finfo(float).eps
_RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")


def polar_sign(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH."""
    size = len(matrix)
    x = matrix / max(np.linalg.norm(matrix), np.finfo(float).tiny)
    # A lower bound of the least singular value; too small a one costs a step or two.
    try:
        low = max(0.9 / max(np.linalg.norm(np.linalg.inv(x)), 1.0), EPS)
    except np.linalg.LinAlgError:
        low = EPS
    for _ in range(24):
        d = np.cbrt(4 * (1 - low * low) / low ** 4)
        root = np.sqrt(1 + d)
        a = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low * low) / (low * low * root))) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        if c > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(size)]))[0]
            new = b / c * x + (a - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        else:
            lower = np.linalg.cholesky(np.eye(size) + c * x.T @ x)
            new = b / c * x + (a - b / c) * np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (a + b * low * low) / (1 + c * low * low))
        if moved < np.cbrt(EPS) / 10 and abs(1 - low) < 1e-8:
            break
    return x


def _bases(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of its complement."""
    size = len(projector)
    chance = np.random.default_rng(size * 1009 + rank)
    inside = np.linalg.qr(projector @ chance.normal(size=(size, rank)))[0]
    inside = np.linalg.qr(projector @ inside)[0]
    whole = np.linalg.qr(np.hstack([inside, chance.normal(size=(size, size - rank))]))[0]
    return whole[:, :rank], whole[:, rank:]


def _split(matrix: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces, or None for a multiple of the identity."""
    size = len(matrix)
    diagonal = np.sort(np.diag(matrix))
    spread = np.linalg.norm(matrix - np.trace(matrix) / size * np.eye(size))
    if spread <= 4 * size * EPS * scale:
        return None
    best = None
    # The median splits evenly; the mean lies between the eigenvalues for sure. Shifts
    # a little beside them help where one falls on an eigenvalue.
    for shift in (np.median(diagonal), np.trace(matrix) / size):
        for step in (0.0, 0.031, -0.047):
            sign = polar_sign(matrix - (shift + step * spread / np.sqrt(size)) * np.eye(size))
            rank = int(round((np.trace(sign) + size) / 2))
            if not 0 < rank < size:
                continue
            above, below = _bases((sign + np.eye(size)) / 2, rank)
            left = np.linalg.norm(below.T @ matrix @ above)
            if best is None or left < best[0]:
                best = (left, above, below)
            if left <= 16 * size * EPS * scale:
                return above, below
    return best[1:] if best else None


def spectrum(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, signed so that the
    largest entry of each is positive."""
    size, scale = len(matrix), float(np.linalg.norm(matrix))
    basis = np.empty((size, size))
    todo, at = [np.eye(size)], 0
    while todo:
        frame = todo.pop()
        part = frame.T @ matrix @ frame
        two = _split((part + part.T) / 2, scale) if frame.shape[1] > 1 else None
        if two is None:
            basis[:, at:at + frame.shape[1]] = frame
            at += frame.shape[1]
        else:
            todo += [frame @ two[1], frame @ two[0]]
    basis = np.linalg.qr(basis)[0]
    values = np.einsum("ij,ij->j", basis, matrix @ basis)
    order = np.argsort(-values, kind="stable")
    values, basis = values[order], basis[:, order]
    return values, basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(size)] < 0, -1.0, 1.0)


@dataclass(frozen=True)
class Model:
    """What every row is whitened by. Its size is that of a vector times the
    number of components, whatever the number of rows."""

    n: int
    #: The rounded-down mean of each dimension, and what the sum has beyond it.
    floor: np.ndarray
    rest: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor).astype(float) - np.array(self.rest, float) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sums of squares of ``n*x - S``."""
        near = x - self.floor
        most = (int(np.abs(near).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) < LONG:
            away = near * self.n - np.array(self.rest, np.int64)
            return (away * away).sum(axis=1).tolist()
        sums = (sum((self.n * v - r) ** 2 for v, r in zip(row, self.rest)) for row in near.tolist())
        return [s if s <= LONG else None for s in sums]


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _totals(fit: DataFrame, part, name: str) -> np.ndarray:
    """The sum over all rows of the matrix that ``part`` makes of a batch. Each
    partition sends one matrix; its entries are added by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                matrix = part(_rows(batch))
                total = matrix if total is None else total + matrix
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist())], ["i", "row"])

    kind = {"long": "decimal(38,0)"}.get(name, name)
    sums = fit.mapInArrow(run, f"i int, row array<{name}>").select("i", F.posexplode("row").alias("j", "value"))
    found = sums.groupBy("i", "j").agg(F.sum(F.col("value").cast(kind)).alias("value")).collect()
    out = np.zeros((1 + max(r.i for r in found), 1 + max(r.j for r in found)), object if name == "long" else float)
    for r in found:
        out[r.i, r.j] = int(r.value) if name == "long" else r.value
    return out


def fit_model(fit: DataFrame, n: int, components: int = COMPONENTS) -> Model | None:
    """``fit`` has each different integer vector once, as ``x``."""
    mask = (1 << LOW_BITS) - 1
    high, low = _totals(fit, lambda x: np.stack([(x >> LOW_BITS).sum(axis=0), (x & mask).sum(axis=0)]), "long")
    sums = [(int(h) << LOW_BITS) + int(v) for h, v in zip(high, low)]
    floor, rest = np.array([s // n for s in sums], np.int64), tuple(s % n for s in sums)

    def products(x: np.ndarray) -> np.ndarray:
        near = (x - floor).astype(float)
        return near.T @ near

    share = np.array(rest, float) / n
    covariance = _totals(fit, products, "double") / n - np.outer(share, share)
    values, vectors = spectrum((covariance + covariance.T) / 2)
    wide = values > max(1, len(values)) * EPS * max(values[0], 0.0)
    wide[components:] = False
    if not wide.any():
        return None
    return Model(n, floor, rest, vectors[:, wide], values[wide], values[wide] / np.trace(covariance))


def identity_error(fit: DataFrame, model: Model) -> float:
    """How far the whitened fit list's covariance is from the identity, at most."""
    def products(x: np.ndarray) -> np.ndarray:
        white = model.whiten(x)
        return np.vstack([white.T @ white, white.sum(axis=0)])

    totals = _totals(fit, products, "double") / model.n
    mean = totals[-1]
    return float(np.abs(totals[:-1] - np.outer(mean, mean) - np.eye(len(mean))).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of
    every row that is kept, one row a component."""
    spark = vectors.sparkSession
    held = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vec")).where(F.col("vec").isNotNull()).where(
        F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    whole = F.transform("vec", lambda c: F.floor(F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), c * SCALE))) + F.lit(SHIFT).cast("long"))
    width = held.agg(F.max(F.size("vec"))).first()[0]
    if not width:
        return spark.createDataFrame([], _RESULT)
    rows = held.select("vec_id", F.concat(whole, F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("vec"))).alias("x"))
    fit = store(rows.select("x").distinct(), "fit-list")
    n = fit.count()
    model = fit_model(fit, n, components)
    if model is None:
        return spark.createDataFrame([], _RESULT)
    shared = spark.sparkContext.broadcast((model, identity_error(fit, model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, error = shared.value
        k = len(known.values)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, each = _rows(batch), np.repeat(np.arange(batch.num_rows), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").cast(pa.int64()).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), known.n)), pa.array(known.deviations(x), pa.int64()).take(pa.array(each)),
                pa.array(known.whiten(x).ravel()), pa.array(np.tile(known.explained, len(x))), pa.array(np.full(len(each), error)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, _RESULT)
