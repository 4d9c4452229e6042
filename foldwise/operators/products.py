"""Matrix products over rows of feature vectors: Gram sums by fold, and leading singular values.

A task multiplies its own rows in numpy and gives one small matrix; the matrices of some
2 sqrt(n) of n tasks are added in one group, and the groups' sums in the next step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The most features whose squares are summed: 32 MB a task, and a fold on the driver.
WIDEST_SQUARE = 2048
#: Entries of a dense block or of a sparse product that a task holds at once.
ENTRIES = 1 << 20
#: Numbers in one row of a matrix on its way.
PIECE = 1 << 14


def _blocks(batch: pa.RecordBatch, column: str, width: int) -> Iterator[tuple[slice, Callable, Callable]]:
    """Slices of a batch of vectors, each with ``X @ m`` and ``X.T @ m`` as functions."""
    vectors = batch.column(column)
    dense = np.asarray(vectors.field("type")) == 1
    values, indices = vectors.field("values"), vectors.field("indices")
    ends = np.cumsum([len(v) for v in values])
    first = 0
    while first < len(ends):
        begun = ends[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(ends, begun + ENTRIES, "right")))
        rows = stop - first
        x = np.asarray(values.slice(first, rows).flatten(), float)
        if dense[first:stop].all():
            block = x.reshape(rows, width)
            yield slice(first, stop), block.__matmul__, block.T.__matmul__
        else:
            at = np.concatenate([
                np.arange(width) if dense[i] else np.asarray(indices[i].values, np.int64) for i in range(first, stop)
            ])
            row = np.repeat(np.arange(rows), np.diff(np.concatenate([[begun], ends[first:stop]])))
            yield (
                slice(first, stop), lambda m, a=(rows, row, x, at): _summed(a[0], a[1], a[2], m[a[3]]),
                lambda m, a=(width, at, x, row): _summed(a[0], a[1], a[2], m[a[3]]),
            )
        first = stop


def _summed(size: int, to: np.ndarray, factor: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.column_stack([np.bincount(to, factor * c, size) for c in rows.T])


def _sum_matrices(parts: DataFrame, keys: Sequence[str]) -> dict[tuple, np.ndarray]:
    """Sums of the rows ``(keys, piece, x array)`` in two steps, as one flat array a key."""
    group = F.floor(F.sqrt(F.spark_partition_id())).alias("_group")
    sums = parts.select(*keys, "piece", array_to_vector("x").alias("v"), group)
    for by in ([*keys, "piece", "_group"], [*keys, "piece"]):
        sums = sums.groupBy(*by).agg(Summarizer.sum(F.col("v")).alias("v"))
    rows = sums.select(*keys, "piece", vector_to_array("v").alias("x")).collect()
    out: dict[tuple, list] = {}
    for r in sorted(rows, key=lambda r: r["piece"]):
        out.setdefault(tuple(r[k] for k in keys), []).append(np.array(r["x"]))
    return {k: np.concatenate(pieces) for k, pieces in out.items()}


def _pieces(key: Sequence, matrix: np.ndarray) -> Iterator[list]:
    flat = matrix.ravel()
    for i in range(0, len(flat), PIECE):
        yield [*key, i // PIECE, flat[i:i + PIECE]]


def _batch(rows: list[list], names: Sequence[str], types: Sequence[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=list(names)
    )


@dataclass
class Moments:
    """Sums over rows of ``[1, features, label]`` times itself; sums of parts add up, and subtract."""

    square: np.ndarray

    def ridge(self, alpha: float) -> tuple[float, np.ndarray]:
        """Intercept and weights of least squares with penalty ``alpha * |w|^2``, the intercept free."""
        n, d = self.square[0, 0], len(self.square) - 2
        centred = self.square - np.outer(self.square[0], self.square[0]) / n
        xx, xy = centred[1:-1, 1:-1], centred[1:-1, -1]
        w = np.linalg.lstsq(xx + alpha * np.eye(d), xy, rcond=None)[0]
        return float((self.square[0, -1] - self.square[0, 1:-1] @ w) / n), w

    def mse(self, intercept: float, w: np.ndarray) -> float:
        """Mean squared error of a line on these rows, without another look at them."""
        line = np.concatenate([[-intercept], -w, [1.0]])
        return float(line @ self.square @ line / self.square[0, 0])


def moments_by_fold(df: DataFrame, features: str, label: str, fold: str, width: int) -> dict[int, Moments]:
    """The moments of every fold in one pass; NULL features, labels or folds are left out.

    The driver holds a square of the features a fold, so vectors above ``WIDEST_SQUARE`` raise.
    """
    if width > WIDEST_SQUARE:
        raise ValueError(f"{width} features; squares are summed up to {WIDEST_SQUARE}")
    size = width + 2

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        eye = np.eye(width)
        for batch in batches:
            y, of = np.asarray(batch.column("y"), float), np.asarray(batch.column("f"))
            for rows, times, _ in _blocks(batch, "x", width):
                full = np.column_stack([np.ones(rows.stop - rows.start), times(eye), y[rows]])
                for f in np.unique(of[rows]):
                    mine = full[of[rows] == f]
                    sums[int(f)] = sums.get(int(f), 0.0) + mine.T @ mine
        out = [row for f, m in sums.items() for row in _pieces([f], m)]
        if out:
            yield _batch(out, ["f", "piece", "x"], [pa.int32(), pa.int32(), pa.list_(pa.float64())])

    known = df.select(F.col(features).alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("f"))
    parts = known.dropna().mapInArrow(multiply, "f int, piece int, x array<double>")
    return {k[0]: Moments(m.reshape(size, size)) for k, m in _sum_matrices(parts, ["f"]).items()}


def ridge_path(
    df: DataFrame, features: Sequence[str], label: str, alphas: Sequence[float], fold: str = "fold"
) -> DataFrame:
    """``(fold, alpha, mse, intercept, weights)`` of ridge fits on the other folds, scored on the fold.

    All folds and penalties cost one scan: a training set's sums are the whole's less its fold's,
    and the squared error of a line follows from the fold's own sums. Rows with a NULL take no
    part; a fold whose training set is empty gives no row.
    """
    known = df.dropna(subset=[*features, label, fold])
    known = VectorAssembler(inputCols=list(features), outputCol="_features").transform(known)
    parts = moments_by_fold(known, "_features", label, fold, len(features))
    rows = []
    for held, own in sorted(parts.items()):
        others = [m.square for f, m in parts.items() if f != held]
        if not others:
            continue
        train = Moments(sum(others[1:], others[0]))
        for alpha in alphas:
            intercept, w = train.ridge(alpha)
            rows.append((held, float(alpha), own.mse(intercept, w), intercept, w.tolist()))
    return df.sparkSession.createDataFrame(
        rows, "fold int, alpha double, mse double, intercept double, weights array<double>"
    )


def leading_singular(
    df: DataFrame, vector: str, k: int, width: int, extra: int = 10, passes: int = 40, tolerance: float = 1e-10,
    seed: int = 42,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading singular values of the rows and their right vectors (features x k).

    A random range of ``k + extra`` columns is multiplied by ``A^T A`` pass by pass, until the
    values change by less than ``tolerance`` of themselves or ``passes`` are over, and a
    tall-skinny QR of the rows times that range gives the values. Driver and tasks hold
    ``width * (k + extra)`` numbers, never a square of the features. NULL rows are left out.
    """
    columns = min(width, k + extra)
    rows = df.select(F.col(vector).alias("x")).where(F.col("x").isNotNull())
    context = df.sparkSession.sparkContext
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, columns)))[0]
    last = None
    for _ in range(passes):
        held = context.broadcast(basis)

        def multiply(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for _, times, back in _blocks(batch, "x", width):
                    part = back(times(held.value))
                    total = part if total is None else total + part
            if total is not None:
                yield _batch(list(_pieces([], total)), ["piece", "x"], [pa.int32(), pa.list_(pa.float64())])

        summed = _sum_matrices(rows.mapInArrow(multiply, "piece int, x array<double>"), [])
        held.unpersist()
        if not summed:
            return np.zeros(0), np.zeros((width, 0))
        left, squares, _ = np.linalg.svd(summed[()].reshape(width, columns), full_matrices=False)
        basis, now = left, squares[:k]
        if last is not None and np.all(np.abs(now - last) <= tolerance * np.maximum(now, np.finfo(float).tiny)):
            break
        last = now
    held = context.broadcast(basis)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, columns))
        for batch in batches:
            for _, times, _ in _blocks(batch, "x", width):
                r = np.linalg.qr(np.vstack([r, times(held.value)]), mode="r")
        if len(r):
            yield _batch([[r.ravel()]], ["r"], [pa.list_(pa.float64())])

    def stack(group):
        r = np.linalg.qr(np.vstack([np.reshape(v, (-1, columns)) for v in group["r"]]), mode="r")
        return group.head(1)[[]].assign(r=[r.ravel()])

    factors = rows.mapInArrow(reduce, "r array<double>").withColumn("g", F.floor(F.sqrt(F.spark_partition_id())))
    top = factors.groupBy("g").applyInPandas(stack, "r array<double>").collect()
    _, values, turn = np.linalg.svd(np.vstack([np.reshape(v["r"], (-1, columns)) for v in top]), full_matrices=False)
    held.unpersist()
    return values[:k], (basis @ turn.T)[:, :k]
