"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers x, so that sums and deviations are exact.  The
principal axes of the centred rows X come from the bidiagonalisation
``X V = U B``, one column at a time:

* ``u = X v`` with its parts along the columns of U so far taken away, then
  ``v = Xᵀ u`` with its parts along V taken away, both normalised; the norms
  are the entries of the bidiagonal B.
* U has a row per vector and is never stored: every column of U is X times a
  known vector of the width of the embeddings, so a task rebuilds its rows of
  U from its rows of X.  One pass over the rows gives ``Xᵀ u`` and the
  products of u with all columns of U, by which u is orthogonalised once more
  (full reorthogonalisation; a pass is repeated if it took much away).
* where the recurrence breaks off (a repeated or a zero deviation), it goes on
  with a random direction orthogonal to V.

It runs through all dimensions, so no component is missed; ``max_steps`` ends
it earlier for wide embeddings, once the wanted components have converged.
The singular vectors of B, a small matrix, give the components.  The driver
holds only vectors of the width of the embeddings, one per step.

Defined cases: rows whose vector is null or has null or non-finite entries are
left out; a shorter vector counts as filled up with entries of 0 to the length
of the longest; entries x beyond 2**48 count as 2**48; a deviation beyond the
range of a long is null; repeated rows and rows with a null id are rows of
their own; components without any deviation (up to rounding) are not returned,
as they cannot be scaled to 1, so a table of equal rows, like an empty one,
gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import Workspace

SCALE, SHIFT = 1024, 100_000
MOST = 1 << 48
#: Rows of an Arrow batch: its partial sums of whole numbers stay below 2**63.
BATCH = 4096
#: A component's deviation below this share of the largest is rounding.
RANK = 1e-13


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """Lists of numbers as rows, shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy().astype(dtype, copy=False)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def whole_numbers(width: int):
    """(vec_id, x): entries scaled, floored and shifted."""
    def run(batches):
        for batch in batches:
            c = _matrix(batch.column(1), np.float64)
            x = np.full((len(c), width), SHIFT, np.int64)
            x[:, :c.shape[1]] = np.clip(np.floor(c * SCALE), -MOST, MOST).astype(np.int64) + SHIFT
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(np.arange(0, x.size + 1, width or 1, dtype=np.int32)[:len(x) + 1], pa.array(x.ravel()))],
                ["vec_id", "x"])

    return run


def _sums(batches):
    """Column sums of each batch: (i, total)."""
    for batch in batches:
        total = _matrix(batch.column(0), np.int64).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, pa.int64())], ["i", "total"])


class Centre:
    """The mean as quotient and remainder of the exact sums, so that centred
    rows are exact up to one rounding."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.quotient = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n for s in sums], dtype=np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.quotient).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int]:
        """sum over dimensions of (n * x - S)**2, exactly."""
        away = x - self.quotient
        most = self.n * int(np.abs(away).max(initial=0)) + self.n
        if most * most * max(1, x.shape[1]) < 1 << 62:
            return ((self.n * away - self.rest) ** 2).sum(axis=1).tolist()
        return [sum((self.n * a - r) ** 2 for a, r in zip(row, self.rest.tolist(), strict=True)) for row in away.tolist()]


def _row(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["total"])


def _product(centre: Centre, w: np.ndarray, basis: np.ndarray):
    """For u = X w: the sums Xᵀ u, (X basis)ᵀ u and uᵀ u over a task's rows."""
    def run(batches):
        total = np.zeros(len(w) + basis.shape[1] + 1)
        for batch in batches:
            x = centre.rows(_matrix(batch.column(0), np.int64))
            u = x @ w
            total += np.concatenate((x.T @ u, (x @ basis).T @ u, [u @ u]))
        yield _row(total)

    return run


def _squares(centre: Centre):
    """Column sums of squared centred entries."""
    def run(batches):
        total = np.zeros(len(centre.quotient))
        for batch in batches:
            total += (centre.rows(_matrix(batch.column(0), np.int64)) ** 2).sum(axis=0)
        yield _row(total)

    return run


def _totals(width: int):
    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            total += _matrix(batch.column(0), np.float64).sum(axis=0)
        yield _row(total)

    return run


def _products(mean: np.ndarray):
    """Sums of the products of the scores' columns, centred first."""
    def run(batches):
        total = np.zeros(len(mean) ** 2)
        for batch in batches:
            away = _matrix(batch.column(0), np.float64) - mean
            total += (away.T @ away).ravel()
        yield _row(total)

    return run


#: Tasks whose sums the driver adds itself; those of more are added in between.
TASKS = 1000


def _add_up(data: DataFrame, tasks: int, sums, width: int) -> np.ndarray:
    """Sum over the ``tasks`` tasks of the one row of ``width`` numbers that
    ``sums`` makes."""
    rows = data.mapInArrow(sums, "total array<double>")
    if tasks > TASKS:
        rows = rows.repartition(max(1, TASKS // 8)).mapInArrow(_totals(width), "total array<double>")
    table = rows.toArrow()
    return np.sum(table.column(0).combine_chunks().flatten().to_numpy().reshape(-1, width), axis=0) if table.num_rows else np.zeros(width)


class Bidiagonal:
    """The recurrence.  Columns of V, W (with U = X W) and Z = Xᵀ U, all of
    the embeddings' width, and the two diagonals of B."""

    def __init__(self, product, width: int, seed: int = 7):
        self.product, self.width, self.random = product, width, np.random.default_rng(seed)
        self.v, self.w, self.z = (np.zeros((width, 0)) for _ in range(3))
        self.alpha: list[float] = []
        self.beta: list[float] = []  # beta[j] couples columns j and j + 1
        self.scale = 0.0

    def _off(self, v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - self.v @ (self.v.T @ v)
        return v

    def _fresh(self) -> np.ndarray | None:
        v = self._off(self.random.standard_normal(self.width))
        size = np.linalg.norm(v)
        return v / size if size > 1e-8 else None

    def _column(self, v: np.ndarray) -> None:
        """u = X v without its parts along U, and Xᵀ u."""
        w = v - self.w @ (self.z.T @ v)  # Uᵀ X v = Zᵀ v
        for _ in range(4):
            z, along, square = self.product(w, self.w)
            rest = max(0.0, square - along @ along)
            w, z = w - self.w @ along, z - self.z @ along
            if square <= 0 or rest >= 0.99 * square:
                break
        size = np.sqrt(rest)
        self.scale = max(self.scale, size)
        zero = size <= 1e-15 * self.scale or not size
        self.alpha.append(0.0 if zero else size)
        self.v = np.column_stack((self.v, v))
        self.w = np.column_stack((self.w, 0 * w if zero else w / size))
        self.z = np.column_stack((self.z, 0 * z if zero else z / size))

    def run(self, steps: int, wanted: int, complete: int) -> None:
        v = self._fresh()
        while v is not None:
            self._column(v)
            if len(self.alpha) == min(steps, self.width):
                return
            v = self._off(self.z[:, -1] - self.alpha[-1] * self.v[:, -1])
            size = np.linalg.norm(v)
            if size > 1e-14 * self.scale:
                v, beta = v / size, size
            else:  # the space is exhausted: B falls into two blocks here
                v, beta = self._fresh(), 0.0
            if len(self.alpha) >= complete and self.converged(wanted, beta):
                return
            self.beta.append(beta)

    def small(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular value decomposition of B."""
        return np.linalg.svd(np.diag(self.alpha) + np.diag(self.beta[:len(self.alpha) - 1], 1))

    def converged(self, wanted: int, beta: float) -> bool:
        left, value, _ = self.small()
        return len(value) >= wanted and bool((beta * np.abs(left[-1, :wanted]) <= 1e-15 * value[0]).all())


def _whiten(centre: Centre, axes: np.ndarray):
    """(vec_id, deviation, scores on the scaled axes)."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), np.int64)
            scores = centre.rows(x) @ axes
            exact = [d if d < 1 << 63 else None for d in centre.deviation(x)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(exact, pa.int64()),
                 pa.ListArray.from_arrays(np.arange(0, scores.size + 1, scores.shape[1], dtype=np.int32), pa.array(scores.ravel()))],
                ["vec_id", "deviation", "scores"])

    return run


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8, max_steps: int | None = None) -> DataFrame:
    """Returns per row and component: (id_col, component, n, deviation,
    whitened, explained, identity_error).  Without ``max_steps`` every
    dimension is worked off; with it, the run ends there, or as soon as the
    wanted components have converged after twice as many steps."""
    spark = embeddings.sparkSession
    ws = Workspace(spark, "whitening")
    vector = F.col(vector_col)
    usable = embeddings.where(vector.isNotNull() & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    rows = usable.select(F.col(id_col).cast("long").alias("vec_id"), vector.cast("array<double>").alias("c"))
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("c")), F.lit(0))).first()
    shape = f"{id_col} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    nothing = spark.createDataFrame([], shape)
    if not n or not width:
        return nothing
    data = ws.put(rows.mapInArrow(whole_numbers(width), "vec_id long, x array<long>"), text_batch=BATCH)
    sums = [0] * width
    for i, total in data.select("x").mapInArrow(_sums, "i int, total long").groupBy("i").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect():
        sums[i] = int(total)
    centre = Centre(n, sums)
    vectors = data.select("x")
    tasks = vectors.rdd.getNumPartitions()

    def product(w, basis):
        got = _add_up(vectors, tasks, _product(centre, w, basis), width + basis.shape[1] + 1)
        return got[:width], got[width:-1], got[-1]

    found = Bidiagonal(product, width)
    found.run(max_steps or width, components, 2 * components if max_steps else width)
    _, value, right = found.small()
    value, axes = value[:components], (found.v @ right.T)[:, :components]
    keep = value ** 2 > RANK * value[0] ** 2 if value[0] > 0 else np.zeros(0, bool)
    if not keep.any():
        return nothing
    value, axes = value[keep], axes[:, keep]
    spread = value ** 2 / n  # variances along the components
    trace = float(_add_up(vectors, tasks, _squares(centre), width).sum()) / n
    scores = ws.put(data.mapInArrow(_whiten(centre, axes / np.sqrt(spread)), "vec_id long, deviation long, scores array<double>"), text_batch=BATCH)
    k = len(spread)
    column = scores.select("scores")
    mean = _add_up(column, tasks, _totals(k), k) / n
    cross = _add_up(column, tasks, _products(mean), k * k).reshape(k, k) / n
    error = float(np.abs(cross - np.eye(k)).max())
    share = F.element_at(F.array(*[F.lit(float(e / trace)) for e in spread]), F.col("component"))
    return scores.select(F.col("vec_id").alias(id_col), "deviation", F.posexplode("scores").alias("at", "whitened")).select(
        id_col, (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened").withColumns(
        {"explained": share, "identity_error": F.lit(error)})
