"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

Each entry c of a vector becomes the whole number x = floor(64 c) + 1000000. The fit list is every distinct
x vector once; its n and sums S are exact. A vector is centred as (x - m) - (S / n - m) with m the whole
number nearest to S / n, so that centring loses no digits, before anything is multiplied.

The scatter of the centred vectors is summed per task by matrix products, then by entry over all tasks.
Its pivoted Cholesky factor L (stopping where the rest is rounding) has as many columns as the scatter has
rank. One-sided Jacobi rotates pairs of columns of L, disjoint pairs at once, until all are orthogonal:
since L L' is the scatter, the squared norms of the rotated columns are its eigenvalues, and the columns,
normalised, are the components. Their sign makes the entry of the largest size positive.

Vectors are shuffled once, to make them distinct, and rows equal in a task are one before that. What is
gathered is one task's matrix of the entries of a scatter, and on the driver, per length of vectors, the
sums and ``COMPONENTS`` components: the length of a vector bounds them, not the number of rows.

Defined results: rows whose vector is null or empty, or holds a null, non-finite or huge entry (64 c not
below 2^53 in size, so that x would not be exact) give no row. Vectors of different lengths are fitted
apart. Components are numbered up to the rank of the scatter; where all vectors are equal there is none, and
no row. Rows with equal or null ids each give rows. ``deviation`` is null where it does not fit a long.
An empty table gives an empty result. Columns other than ``vec_id`` and ``embedding`` are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeline.llm.common import shared_folder, stored

# Fixed values of the contract.
SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16

#: Rows that are multiplied at once.
SLICE = 2048
EPSILON = float(np.finfo(float).eps)
_LOW = 26  # sums are kept as two longs, of x >> 26 and of the lowest 26 bits

WHITENED = """vec_id long, component int, n long, deviation long, whitened double,
    explained double, identity_error double"""


@dataclass
class Model:
    """The fit of one vector length; ``whole`` + ``rest`` / n is the mean."""

    n: int
    whole: np.ndarray
    rest: list[int]
    components: np.ndarray | None = None
    eigenvalues: np.ndarray | None = None
    trace: float = 0.0
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - np.array([r / self.n for r in self.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2 of each row, in whole numbers."""
        y = x - self.whole
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.rest))
        if most**2 * x.shape[1] < 1 << 62:
            away = self.n * y - np.array(self.rest, np.int64)
            return (away * away).sum(axis=1).tolist()
        away = self.n * y.astype(object) - np.array(self.rest, object)
        return [d if d < 1 << 63 else None for d in (away * away).sum(axis=1)]


def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``d`` (the length) and ``x`` of every row with a usable vector."""
    fits = lambda e: (
        e.isNotNull() & ~F.isnan(e) & (F.abs(SCALE * e.cast("double")) < float(1 << 53))
    )
    usable = F.coalesce(F.size("embedding") > 0, F.lit(False)) & F.forall("embedding", fits)
    x = F.transform("embedding", lambda e: F.floor(SCALE * e.cast("double")) + SHIFT)
    return vectors.filter(usable).select("vec_id", F.size("embedding").alias("d"), x.alias("x"))


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L (rows in the order of ``a``, one column per pivot) with L L' = a up to rounding."""
    d = len(a)
    left, factor, open_rows = np.diag(a).copy(), np.zeros((d, d)), np.ones(d, bool)
    least = d * EPSILON * max(left.max(initial=0.0), 0.0)
    for k in range(d):
        pivot = int(np.argmax(np.where(open_rows, left, -1.0)))
        if not open_rows[pivot] or left[pivot] <= least:
            return factor[:, :k]
        column = (a[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / np.sqrt(left[pivot])
        factor[:, k] = np.where(open_rows, column, 0.0)
        left -= factor[:, k] ** 2
        open_rows[pivot] = False
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of a factor rotated until they are orthogonal, as rows."""
    rows = np.ascontiguousarray(factor.T)
    if len(rows) % 2:
        rows = np.vstack([rows, np.zeros(rows.shape[1])])
    half, order = len(rows) // 2, np.arange(len(rows))
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(rows) - 1):
            p, q = order[:half], order[:half - 1:-1]
            a, b = rows[p], rows[q]
            aa, bb, ab = ((v * w).sum(axis=1) for v, w in ((a, a), (b, b), (a, b)))
            cosine = np.abs(ab) / np.maximum(np.sqrt(aa) * np.sqrt(bb), np.finfo(float).tiny)
            turn = cosine > EPSILON
            ratio = (bb - aa) / np.where(turn, 2 * ab, 1.0)
            tangent = np.where(ratio < 0, -1.0, 1.0) / (np.abs(ratio) + np.hypot(1.0, ratio))
            tangent = np.where(turn, tangent, 0.0)
            c = 1 / np.hypot(1.0, tangent)
            s = c * tangent
            rows[p], rows[q] = c[:, None] * a - s[:, None] * b, s[:, None] * a + c[:, None] * b
            worst = max(worst, cosine.max(initial=0.0))
            order = np.concatenate([order[:1], order[-1:], order[1:-1]])
        if worst <= 4 * EPSILON:
            break
    return rows


def eigen(scatter: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the covariance in falling order, and unit components as rows."""
    rows = one_sided_jacobi(pivoted_cholesky(scatter / n))
    values = (rows * rows).sum(axis=1)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > len(scatter) * EPSILON * values.max(initial=0.0)]
    components = rows[order] / np.sqrt(values[order])[:, None]
    largest = np.abs(components).argmax(axis=1)
    signs = np.where(components[np.arange(len(order)), largest] < 0, -1.0, 1.0)
    return values[order], components * signs[:, None]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """The rows of a batch by length, in slices, with their vectors as a matrix."""
    lengths = batch.column("d").to_numpy()
    for d in np.unique(lengths):
        own = batch.filter(pa.array(lengths == d))
        for k in range(0, own.num_rows, SLICE):
            part = own.slice(k, SLICE)
            yield int(d), part, part.column("x").flatten().to_numpy().reshape(-1, d)


def _summed(fit: DataFrame, of: Callable[[int, np.ndarray], np.ndarray]) -> DataFrame:
    """``d, i, j, value``: the upper triangle of the sum of a matrix per slice over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {}
        for batch in batches:
            for d, _, x in _blocks(batch):
                part = of(d, x)
                totals[d] = totals[d] + part if d in totals else part
        for d, total in totals.items():
            i, j = np.triu_indices(len(total)) if total.ndim == 2 else (np.arange(len(total)),) * 2
            value = total[i, j] if total.ndim == 2 else total
            columns = [np.full(len(i), d, np.int32), i.astype(np.int32), j.astype(np.int32), value]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["d", "i", "j", "value"])

    parts = fit.mapInArrow(run, "d int, i int, j int, value double")
    return parts.groupBy("d", "i", "j").agg(F.sum("value").alias("value"))


def _square(entries: pa.Table, d: int) -> np.ndarray:
    matrix = np.zeros((d, d))
    i, j, value = (entries[c].to_numpy() for c in ("i", "j", "value"))
    matrix[i, j] = value
    matrix[j, i] = value
    return matrix


def fitted(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """The model of each vector length from the fit list (``d, x``, distinct)."""
    low = F.lit((1 << _LOW) - 1).cast("long")
    sums = (
        fit.select("d", F.posexplode("x").alias("i", "x"))
        .groupBy("d", "i")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.shiftright("x", _LOW)).alias("high"),
            F.sum(F.col("x").bitwiseAND(low)).alias("low"),
        )
        .orderBy("d", "i")
    )
    total: dict[int, tuple[int, list[int]]] = {}
    for r in sums.collect():
        total.setdefault(r.d, (r.n, []))[1].append((r.high << _LOW) + r.low)
    models = {}
    for d, (n, s) in total.items():
        whole = [(2 * v + n) // (2 * n) for v in s]
        rest = [v - n * w for v, w in zip(s, whole)]
        models[d] = Model(n, np.array(whole, np.int64), rest)

    def scatter(d: int, x: np.ndarray) -> np.ndarray:
        z = models[d].centred(x)
        return z.T @ z

    counts = {d: m.n for d, m in models.items()}

    def solved(entries: pa.Table) -> pa.Table:
        d = entries["d"][0].as_py()
        matrix = _square(entries, d)
        values, vectors = eigen(matrix, counts[d])
        kept = min(components, len(values))
        return pa.table(
            {
                "d": pa.array([d], pa.int32()),
                "trace": pa.array([float(np.trace(matrix)) / counts[d]]),
                "eigenvalues": pa.array([values[:kept].tolist()], pa.list_(pa.float64())),
                "vectors": pa.array([vectors[:kept].ravel().tolist()], pa.list_(pa.float64())),
            }
        )

    shape = "d int, trace double, eigenvalues array<double>, vectors array<double>"
    for r in _summed(fit, scatter).groupBy("d").applyInArrow(solved, shape).collect():
        model = models[r.d]
        model.trace, model.eigenvalues = r.trace, np.array(r.eigenvalues)
        model.components = np.array(r.vectors).reshape(len(r.eigenvalues), r.d)

    # the covariance of what whitening gives, centred first
    means = {d: np.zeros(len(m.eigenvalues)) for d, m in models.items()}
    for r in _summed(fit, lambda d, x: models[d].whitened(x).sum(axis=0)).collect():
        means[r.d][r.i] = r.value / models[r.d].n

    def spread(d: int, x: np.ndarray) -> np.ndarray:
        w = models[d].whitened(x) - means[d]
        return w.T @ w

    for r in _summed(fit, spread).collect():
        off = abs(r.value / models[r.d].n - (r.i == r.j))
        models[r.d].identity_error = max(models[r.d].identity_error, off)
    return models


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component, with the columns of ``WHITENED``."""
    folder = shared_folder(vectors.sparkSession)
    rows = stored(quantised(vectors), folder, "quantised")
    fit = stored(rows.select("d", "x").distinct(), folder, "fit")
    models = fitted(fit, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part, x in _blocks(batch):
                model = models[d]
                kept, count = len(model.eigenvalues), len(x)
                each = np.repeat(np.arange(count), kept)
                repeated = lambda column: column.take(pa.array(each))
                tiled = lambda values, kind: pa.array(np.tile(values, count), kind)
                yield pa.RecordBatch.from_arrays(
                    [
                        repeated(part.column("vec_id")),
                        tiled(np.arange(1, kept + 1), pa.int32()),
                        pa.array(np.full(len(each), model.n), pa.int64()),
                        repeated(pa.array(model.deviation(x), pa.int64())),
                        pa.array(model.whitened(x).ravel(), pa.float64()),
                        tiled(model.eigenvalues / (model.trace or 1.0), pa.float64()),
                        pa.array(np.full(len(each), model.identity_error)),
                    ],
                    names,
                )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    names = [c.split()[0] for c in WHITENED.split(",")]
    return rows.mapInArrow(run, WHITENED.replace("vec_id long", f"vec_id {kind}"))
