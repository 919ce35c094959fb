"""Whitening of embeddings by shifted Cholesky QR.

Entries become integers x = floor(SCALE * c). The fit list holds each distinct vector once; its count and sums are
exact. The centred rows of the fit list are a tall matrix of which only small Gram matrices are ever needed: each
pass adds up the Gram matrix of the rows as orthogonalised so far (rows times the inverse of the factor, by triangular
solves within the tasks), and its Cholesky factor multiplies the factor. A shift keeps the first factorisations
possible when the covariance is singular or badly conditioned; the passes repeat until the Gram matrix is the identity,
or, where some directions have no variance at all, until it changes no more. The singular values and vectors of the
factor then give the components without the square of the condition number that an eigendecomposition of the
covariance would meet.

Gram matrices of tasks are added in a tree, never all in one task; the driver sees one matrix a pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignal.llm.common import staged

SCALE = 256
COMPONENTS = 4
FAN_IN = 64  # partial matrices added by one task
MOST_PASSES, IDENTITY = 8, 1e-12
# Singular values below this share of the largest one are rounding errors of none.
NO_VARIANCE = 1e-13


class Whitening:
    """Count and sums of the fit list, components in columns, their eigenvalues, the trace, and the measured error."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, values: np.ndarray, trace: float, error: float | None = None) -> None:
        self.n, self.sums, self.components, self.values, self.trace, self.error = n, sums, components, values, trace, error


def integers(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """key and x of the rows whose vector is whole: not null, no null or non-finite entry, all entries within a long."""
    whole = f"case when isnan(c) or abs(c) > 9.2e18 / {scale} then null else floor({scale}D * c) + 0 end"
    scaled = F.expr(f"transform(cast(`{vector}` as array<double>), c -> {whole})")
    rows = df.select(F.col(key).cast("long").alias(key), scaled.alias("x")).filter(F.col("x").isNotNull())
    return rows.filter(~F.exists("x", lambda v: v.isNull()) & (F.size("x") > 0))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _added(parts: DataFrame, exact: bool) -> np.ndarray:
    """Sum of the arrays of all rows (task, part), FAN_IN a task and level; the order of additions is the tasks'."""
    kind = pa.int64() if exact else pa.float64()

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        total = None
        for row in table.column("part"):
            values = row.values.to_numpy(zero_copy_only=False)
            total = values if total is None else total + values
        return pa.table({"task": [table.column("task")[0].as_py()], "part": pa.array([total], pa.list_(kind))})

    parts = staged(parts, "partial-sums")
    level, tasks = 1, (parts.agg(F.max("task")).first()[0] or 0) + 1
    while level < tasks:
        level *= FAN_IN
        grouped = parts.withColumn("bin", F.expr(f"task div {level}")).groupBy("bin").applyInArrow(add, parts.schema)
        parts = staged(grouped, "partial-sums")
    row = parts.first()  # one row by now
    return np.array(row.part if row else [], np.int64 if exact else np.float64)


def _per_task(fit: DataFrame, measure, width: int, exact: bool = False) -> np.ndarray:
    """Sum of ``measure`` (rows of x -> array) over all rows of the fit list."""
    kind = pa.int64() if exact else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = None
        for batch in batches:
            if batch.num_rows:
                part = measure(_matrix(batch.column(0), width))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total], pa.list_(kind))], names=["task", "part"])

    return _added(fit.select("x").mapInArrow(run, f"task long, part array<{'long' if exact else 'double'}>"), exact)


def _solved(x: np.ndarray, means: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Centred rows times the inverses of the factors, the first one first; as columns."""
    rows = (x - means).T
    for factor in factors:
        rows = solve_triangular(factor, rows)
    return rows


def solve_triangular(upper: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Solution y of upper' y = columns, forward a row at a time over all columns."""
    solved = np.array(columns, np.float64)
    for i in range(len(upper)):
        solved[i] -= upper[:i, i] @ solved[:i]
        solved[i] /= upper[i, i]
    return solved


def _gram(x: np.ndarray, means: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    rows = _solved(x, means, factors)
    return (rows @ rows.T).ravel()


def _factor(gram: np.ndarray, n: int) -> np.ndarray:
    """Upper Cholesky factor, shifted by as little as makes it exist safely (multiples of rounding)."""
    d = len(gram)
    norm = max(float(np.trace(gram)), np.finfo(float).tiny)
    shift = 0.0
    while True:
        try:
            upper = np.linalg.cholesky(gram + shift * np.eye(d)).T
            if upper.diagonal().min() > np.sqrt(norm) * 1e-10:
                return upper
        except np.linalg.LinAlgError:
            pass
        shift = max(11 * d * (d + 1) * np.finfo(float).eps * norm / 2, 10 * shift)


def fit(vectors: DataFrame, width: int, count: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct ``x`` of ``vectors``, a written table; all of them have ``width`` entries."""
    n = vectors.count()
    sums = [int(v) for v in _per_task(vectors, lambda x: x.sum(axis=0), width, exact=True)]
    means = np.array([s // n + s % n / n for s in sums])
    factors, last = [], None
    for _ in range(MOST_PASSES):
        gram = _per_task(vectors, partial(_gram, means=means, factors=factors), width).reshape(width, width)
        trace = float(np.trace(gram)) / n if not factors else trace
        change = np.abs(gram - (np.eye(width) if last is None else last)).max()
        if trace == 0 or np.abs(gram - np.eye(width)).max() < IDENTITY or last is not None and change < IDENTITY:
            break
        last = gram
        factors.append(_factor(gram, n))
    whole = np.eye(width)
    for factor in factors:
        whole = factor @ whole
    # what the Gram matrix of the last pass lacks to the identity belongs to the factor: X'X = R'GR
    weights, axes = np.linalg.eigh(gram)
    _, sizes, right = np.linalg.svd(np.sqrt(np.maximum(weights, 0))[:, None] * (axes.T @ whole))
    sizes = np.where(sizes > NO_VARIANCE * sizes[0], sizes, 0.0) if trace else np.zeros(width)
    components = right[:count].T
    components = components * np.where(components[np.abs(components).argmax(axis=0), np.arange(components.shape[1])] < 0, -1, 1)
    found = Whitening(n, sums, components, sizes[:count] ** 2 / n, trace)
    found.error = _identity_error(vectors, found, width)
    return found


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Rows projected on the components that have variance, over its root."""
    means = np.array([s // model.n + s % model.n / model.n for s in model.sums])
    seen = model.values > 0
    return (x - means) @ model.components[:, seen] / np.sqrt(model.values[seen])


def _identity_error(vectors: DataFrame, model: Whitening, width: int) -> float | None:
    """Largest deviation of the whitened fit list's covariance from the identity."""
    k = int((model.values > 0).sum())
    if not k:
        return None
    means = _per_task(vectors, lambda x: _whitened(x, model).sum(axis=0), width) / model.n

    def products(x: np.ndarray) -> np.ndarray:
        rows = _whitened(x, model) - means
        return (rows.T @ rows).ravel()

    return float(np.abs(_per_task(vectors, products, width).reshape(k, k) / model.n - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - S)^2 of each row, exact; None beyond a long."""
    most = max(float(np.abs(x).max(initial=0)) * n, max(map(abs, sums))) * 2
    if most < 2.0 ** 31 and most ** 2 * x.shape[1] < 2.0 ** 62:
        return ((n * x - np.array(sums)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained and identity_error of every whole vector and component.

    A row is left out if its vector is null or empty, holds a null, non-finite or (scaled) larger than long entry, or
    is not of the most frequent length (of equally frequent ones the longest). Repeated rows and vectors each get their
    rows, but count once in the fit. There are as many components as entries, at most ``count``. A component
    without variance has explained 0 (null if there is no variance at all) and whitened null; identity_error is taken
    over the others, null if there are none. A deviation beyond a long is null. A null key stays null; other columns
    are ignored; a table without whole vectors gives no rows.
    """
    whole = integers(df, key, vector)
    widths = whole.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    schema = f"`{key}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if widths is None:
        return df.sparkSession.createDataFrame([], schema)
    width = widths.w
    whole = whole.filter(F.size("x") == width)
    model = fit(staged(whole.select("x").distinct(), "fit-list"), width, count)
    k = model.components.shape[1]
    seen = model.values > 0
    explained = [float(v / model.trace) if model.trace else None for v in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            x = _matrix(batch.column(1), width)
            values = np.full((rows, k), np.nan)
            values[:, seen] = _whitened(x, model)
            every = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * k, model.n, np.int64)), pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(every)),
                 pa.array(values.ravel(), mask=np.tile(~seen, rows)), pa.array(explained * rows, pa.float64()),
                 pa.array([model.error] * (rows * k), pa.float64())],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return whole.mapInArrow(run, schema)
