"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

1. Entries become integers, ``floor(scale * c)``; a constant added to them would
   cancel in every result.  One pass counts the rows and sums every dimension
   exactly.
2. A second pass centres every row before it multiplies.  A row's distance from
   the integer next to the mean is exact; the mean's rest (below one half) is
   subtracted as a double.  Each task adds up one scatter matrix; Spark adds the
   tasks' matrices row by row, in a fixed order, so reruns agree.
3. The driver factors that one matrix (dimensions squared, whatever the table's
   size): Cholesky with complete pivoting to the numeric rank, then one-sided
   Jacobi rotations on the columns of the triangular factor itself.  Rounds of a
   tournament rotate disjoint pairs together.  The rotated columns' squared norms
   are the eigenvalues; the normalised columns are the components.
4. A third pass projects all rows and measures the whitened rows' covariance
   the same way (centred first); the last one writes the rows.

Defined cases: rows whose vector is NULL or holds a NULL or non-finite entry are
dropped; NULL and repeated ids are rows like any other; vectors shorter than the
longest one count as padded with zeros; integers beyond +-2^61 are held to that
bound; a deviation that does not fit a long is NULL; components without variance,
or with less than doubles resolve beside the first one, are not returned (their
scale is undefined), so equal rows, a single row and an empty table give no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

SCALE, COMPONENTS = 64.0, 32
LEAST = 2.0 ** 16 * np.finfo(float).eps  # of the greatest standard deviation: what a projection still resolves
MOST = 2.0 ** 61  # integers are held to this bound
ROWS = 4096  # rows of a matrix block
GROUPS = 64  # tasks' matrices are first added in so many groups a matrix row
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Fit:
    """What is known of the fit list: count, sums and, later, components."""

    n: int
    sums: tuple[int, ...]  # of y = floor(scale * c), per dimension
    components: np.ndarray | None = None  # columns
    values: np.ndarray | None = None  # eigenvalues of the covariance
    trace: float = 0.0

    @property
    def whole(self) -> np.ndarray:
        """The integer next to the mean of y, per dimension."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """Mean less ``whole``, exact before its one rounding."""
        return np.array([(s - self.n * int(m)) / self.n for s, m in zip(self.sums, self.whole)])


def kept_rows(batch: pa.RecordBatch, width: int, scale: float) -> tuple[pa.Array, np.ndarray]:
    """Ids and integers ``floor(scale * c)`` of the rows that take part, padded to ``width``."""
    column = batch.column(1)
    here = column.is_valid().to_numpy(zero_copy_only=False)
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    c = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    end = np.cumsum(size)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(c))])
    keep = np.flatnonzero(here & (bad[end] == bad[end - size]))
    entry = np.repeat(end[keep] - size[keep], size[keep]) + _within(size[keep])
    y = np.zeros((len(keep), width), np.int64)
    with np.errstate(over="ignore"):
        y[np.repeat(np.arange(len(keep)), size[keep]), _within(size[keep])] = np.clip(
            np.floor(scale * c[entry]), -MOST, MOST)
    return batch.column(0).take(pa.array(keep)), y


def _within(size: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run."""
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)


def centred(y: np.ndarray, fit: Fit) -> np.ndarray:
    return (y - fit.whole).astype(np.float64) - fit.rest


def deviations(y: np.ndarray, fit: Fit) -> pa.Array:
    """Exact sum over dimensions of (n * y - S)^2; NULL beyond a long."""
    whole = fit.whole
    near = [s - fit.n * int(m) for s, m in zip(fit.sums, whole)]
    d = y - whole
    about = ((float(fit.n) * d) ** 2).sum(axis=1)
    with np.errstate(over="ignore"):
        exact = ((fit.n * d - np.array(near, np.int64)) ** 2).sum(axis=1)  # right wherever the sum is small
    null = about > 2.0 ** 64
    for i in np.flatnonzero((about > 2.0 ** 61) & ~null):
        value = sum((fit.n * a - r) ** 2 for a, r in zip(d[i].tolist(), near))
        null[i] = value >= 2 ** 63
        exact[i] = 0 if null[i] else value
    return pa.array(exact, mask=null)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``L`` with ``a = L @ L.T``, a row-permuted lower triangle with as many columns as the numeric rank."""
    a = a.copy()
    size = len(a)
    order = np.arange(size)
    factor = np.zeros((size, size))
    rank = 0
    left = np.diag(a).copy()
    floor = size * np.finfo(float).eps * left  # what rounding leaves of a dimension that depends on the others
    for k in range(size):
        p = k + int(np.argmax(left[order[k:]]))
        order[[k, p]] = order[[p, k]]
        i = order[k]
        if not left[i] > 0:
            break
        pivot = np.sqrt(left[i])
        below = order[k + 1:]
        column = (a[below, i] - factor[below, :k] @ factor[i, :k]) / pivot
        factor[i, k] = pivot
        factor[below, k] = column
        left[below] -= column ** 2
        left[below] = np.where(left[below] > floor[below], left[below], 0.0)
        rank += 1
    return factor[:, :rank]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of ``factor @ factor.T`` by rotating the columns of ``factor``."""
    g = factor.copy()
    m = g.shape[1]
    seats = list(range(m + m % 2))  # an odd count sits one column out
    tolerance = np.finfo(float).eps * max(1.0, np.sqrt(len(g)))
    for _ in range(sweeps):
        most = 0.0
        for _ in range(max(len(seats) - 1, 0)):
            pairs = [(min(x, y), max(x, y)) for x, y in zip(seats[:len(seats) // 2], reversed(seats)) if max(x, y) < m]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            if not pairs:
                continue
            i, j = (np.array(x) for x in zip(*pairs))
            x, y = g[:, i], g[:, j]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            size = np.sqrt(xx * yy)
            angle = np.divide(np.abs(xy), size, out=np.zeros_like(xy), where=size > 0)
            most = max(most, float(angle.max()))
            turn = angle > tolerance
            if not turn.any():
                continue
            zeta = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            g[:, i], g[:, j] = c * x - c * t * y, c * t * x + c * y
        if most <= tolerance:
            break
    else:
        raise ArithmeticError("the rotations did not converge")
    values = (g * g).sum(axis=0)
    fall = np.argsort(-values, kind="stable")
    values = values[fall]
    return values, g[:, fall] / np.sqrt(values)


def _blocks(width: int, scale: float, batches: Iterator[pa.RecordBatch]):
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            ids, y = kept_rows(whole.slice(at, ROWS), width, scale)
            if len(y):
                yield ids, y


def _matrix(rows: DataFrame, make, size: int, width: int, scale: float) -> np.ndarray:
    """Sum over all rows of ``z.T @ z`` for ``z = make(integers)``: one matrix a task, added row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, y in _blocks(width, scale, batches):
            z = make(y)
            total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["row", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[np.ndarray]] = {}
        for b in batches:
            parts = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            for row, part in zip(b.column(0).to_pylist(), parts):
                totals.setdefault(row, []).append(part)
                if len(totals[row]) >= 1024:
                    totals[row] = [np.sum(totals[row], axis=0)]
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(totals, pa.int32()), pa.array([np.sum(p, axis=0) for p in totals.values()],
                                                        pa.list_(pa.float64()))], ["row", "part"])

    schema = "row int, part array<double>"
    parts = rows.mapInArrow(run, schema).withColumn("g", F.spark_partition_id() % GROUPS)
    # Two steps, so that no task gets a matrix row of every task: first within groups of tasks, then the groups.
    some = parts.repartition(F.col("row"), F.col("g")).sortWithinPartitions("row", "part").select("row", "part")
    some = some.mapInArrow(add, schema)
    whole = some.repartition(F.col("row")).sortWithinPartitions("row", "part").mapInArrow(add, schema)
    out = np.zeros((size, size))
    for r in whole.collect():  # ``size`` rows
        out[r["row"]] = r["part"]
    return out


def fit_components(rows: DataFrame, components: int, scale: float) -> Fit | None:
    """Count, sums, and the leading components of ``rows`` (``vec_id, embedding``); ``None`` without a row."""
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for _, y in _blocks(width, scale, batches):
            n += len(y)
            if np.abs(y).max(initial=0) < 2 ** 50:  # ROWS of them fit a long
                sums = [s + int(t) for s, t in zip(sums, y.sum(axis=0))]
            else:
                sums = [s + sum(c) for s, c in zip(sums, y.T.tolist())]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()),
                                              pa.array([str(s) for s in sums])], ["at", "n", "total"])

    sums = (rows.mapInArrow(count, "at int, n long, total string").groupBy("at")
            .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    if not sums:
        return None
    total = {r["at"]: int(r["total"]) for r in sums}
    fit = Fit(sums[0]["n"], tuple(total[i] for i in range(width)))
    scatter = _matrix(rows, lambda y: centred(y, fit), width, width, scale)
    values, vectors = one_sided_jacobi(pivoted_cholesky(scatter))
    if not len(values):
        return None
    sound = int((np.sqrt(values) > LEAST * np.sqrt(values[0])).sum())
    values, vectors = values[:sound], vectors[:, :sound]
    return Fit(fit.n, fit.sums, vectors[:, :components], values[:components] / fit.n,
               float(np.diag(scatter).sum()) / fit.n)


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per kept row and component."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    fit = fit_components(rows, components, scale)
    if fit is None:
        return spark.createDataFrame([], SCHEMA)
    width, k = len(fit.sums), len(fit.values)

    def project(y: np.ndarray) -> np.ndarray:
        return centred(y, fit) @ fit.components / np.sqrt(fit.values)

    # The whitened rows' own covariance.  They are projections of centred rows, so their mean (its sums are
    # one more column of the product) is rounding, taken off as well.
    moments = _matrix(rows, lambda y: np.column_stack([project(y), np.ones(len(y))]), k + 1, width, scale)
    mean = moments[k, :k] / fit.n
    error = float(np.abs(moments[:k, :k] / fit.n - np.outer(mean, mean) - np.eye(k)).max())
    explained = fit.values / fit.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, y in _blocks(width, scale, batches):
            m = len(y)
            row = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [ids.take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, fit.n, np.int64)), deviations(y, fit).take(row),
                 pa.array(project(y).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, SCHEMA)
