"""Embedding whitening by principal components.

Vectors are put on an integer grid, each distinct one counts once, and four
passes over the distinct vectors, written once, make the model:

1. n and the sum of every dimension, exact integers;
2. per task the sum of the outer products of the centred vectors (a matrix as
   wide as a vector), added up row by row in a shuffle: the covariance;
3. its leading eigenpairs, found on the driver by :mod:`starbi.llm.eigen`
   (Householder tridiagonalisation, Sturm-count bisection, inverse iteration
   with cluster reorthogonalisation);
4. the whitened vectors' own covariance, against the identity.

The model (n, sums, components) is as large as a few vectors and goes to the
tasks, where a scan projects every row.  What reaches the driver is bounded by
the width of a vector, never by the rows.

Cases: rows whose vector is null, empty or holds a null or non-finite entry are
left out; so are rows whose vector is not of the most frequent length (of two as
frequent lengths the longer counts), since they have no place in the space.
Repeated rows and ids, and null ids, all come back.  Equal eigenvalues: any
orthonormal basis of their space, the same for all rows.  Components whose
variance is rounding noise (below ``width * 64`` epsilons of the largest) do not
exist: constant vectors and a single vector give no rows, a table of low rank as
many components as its rank.  Entries beyond 2**45 units of the grid are held
there.  A deviation beyond a long is null.  An empty table gives an empty table;
only the id and vector columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbi.llm import eigen
from starbi.llm.common import stored, workers_see_package

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
EDGE = float(1 << 45)


def usable(vector: Column) -> Column:
    """Not null or empty, and every entry is a finite number."""
    entry_ok = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(entry_ok, F.lit(False))


def on_grid(vector: Column, scale: int = SCALE, offset: int = OFFSET,
            edge: float = EDGE) -> Column:
    """Each entry c as the long floor(scale * c) + offset, scale * c held within the edge."""
    def unit(c: Column) -> Column:
        c = F.greatest(F.least(c.cast("double") * scale, F.lit(edge)), F.lit(-edge))
        return F.floor(c).cast("long") + offset
    return F.transform(vector, unit)


def grid_points(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                scale: int = SCALE, offset: int = OFFSET, edge: float = EDGE,
                **also: Column) -> tuple[DataFrame, int]:
    """Rows (vec_id, x, and the columns of ``also``) of the usable vectors of the
    most frequent length, and that length (0 if there are none)."""
    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v"),
                             *[c.alias(name) for name, c in also.items()]) \
        .where(usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    width = most[0].d if most else 0
    return rows.where(F.size("v") == width).select(
        "vec_id", on_grid(F.col("v"), scale, offset, edge).alias("x"), *also), width


@dataclass(frozen=True)
class Whitening:
    """``sums[i] / n`` is the mean; column k of ``vectors`` is component k + 1."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - mean; the mean's whole part is taken off as an integer."""
        whole = [s // self.n for s in self.sums]
        part = [(s - w * self.n) / self.n for s, w in zip(self.sums, whole)]
        return (x - np.array(whole, np.int64)).astype(float) - np.array(part)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sum) ** 2, exact; None beyond a long."""
        whole = [s // self.n for s in self.sums]
        part = [s - w * self.n for s, w in zip(self.sums, whole)]
        z = x - np.array(whole, np.int64)
        most = self.n * (int(np.abs(z).max(initial=0)) + 1)
        if most * most * max(1, x.shape[1]) >= 1 << 63:
            z = z.astype(object)
        total = ((z * self.n - np.array(part, z.dtype)) ** 2).sum(axis=1)
        return [int(t) if t < 1 << 63 else None for t in total.tolist()]


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _totals(points: DataFrame, width: int) -> tuple[int, tuple[int, ...]]:
    """How many vectors, and the exact sum of each dimension."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for batch in batches:
            x = _matrix(batch, width)
            n += len(x)
            # high and low halves: their sums fit for any batch
            high, low = (x >> 24).sum(axis=0), (x & ((1 << 24) - 1)).sum(axis=0)
            sums = [s + (h << 24) + m for s, h, m in zip(sums, high.tolist(), low.tolist())]
        yield pa.RecordBatch.from_pydict({"dim": pa.array(range(-1, width), pa.int32()),
                                          "total": [str(t) for t in (n, *sums)]})

    whole = points.mapInArrow(per_task, "dim int, total string").groupBy("dim").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    got = {r.dim: int(r.total) for r in whole.collect()}
    return got.get(-1, 0), tuple(got.get(i, 0) for i in range(width))


def _gram(points: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray],
          size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of v and of v v' over the vectors v = ``of(x)`` of ``size`` entries.

    A task gives its matrix as rows; equal rows of all tasks meet in one group
    (as many vectors as there are tasks) and are added in the order of the tasks."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for batch in batches:
            v = of(_matrix(batch, width))
            total[:size] += v.T @ v
            total[size] += v.sum(axis=0)
        yield pa.RecordBatch.from_pydict({
            "place": pa.array(range(size + 1), pa.int32()), "sums": pa.array(list(total)),
            "task": pa.array([TaskContext.get().partitionId()] * (size + 1), pa.int32())})

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")
        parts = rows.column("sums").combine_chunks().flatten().to_numpy().reshape(-1, size)
        return pa.table({"place": rows.column("place")[:1],
                         "sums": pa.array([parts.sum(axis=0)])})

    schema = "place int, sums array<double>"
    whole = points.mapInArrow(per_task, schema + ", task int").groupBy("place") \
        .applyInArrow(add, schema)
    total = np.zeros((size + 1, size))
    for r in whole.collect():
        total[r.place] = r.sums
    return total[size], total[:size]


def fit(points: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """The model of the distinct vectors of ``points`` (a column ``x`` of arrays
    of ``width`` longs); None without vectors."""
    workers_see_package(points.sparkSession)
    distinct = stored(points.select("x").distinct(), "whitening-fit")
    n, sums = _totals(distinct, width)
    if not n:
        return None
    mean = Whitening(n, sums, np.ones(0), np.zeros((width, 0)), 0.0, 0.0)
    rest, outer = _gram(distinct, width, mean.centred, width)
    covariance = outer / n - np.outer(rest / n, rest / n)  # the rest is rounding
    covariance = (covariance + covariance.T) / 2
    values, vectors = eigen.leading(covariance, components)
    real = values > values[:1] * 64 * width * eigen.EPS if values.any() else np.zeros(len(values), bool)
    model = Whitening(n, sums, values[real], vectors[:, real], float(np.trace(covariance)), 0.0)
    k = int(real.sum())
    if not k:
        return model
    rest, outer = _gram(distinct, width, model.project, k)
    error = np.abs(outer / n - np.outer(rest / n, rest / n) - np.eye(k)).max()
    return Whitening(n, sums, model.values, model.vectors, model.trace, float(error))


def project(points: DataFrame, width: int, model: Whitening | None) -> DataFrame:
    """One row per row of ``points`` and component."""
    schema = (f"vec_id {points.schema['vec_id'].dataType.simpleString()}, component int, n long, "
              "deviation long, whitened double, explained double, identity_error double")
    if model is None or not len(model.values):
        return points.sparkSession.createDataFrame([], schema)
    k = len(model.values)
    explained = model.values / model.trace

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, width)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(each),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(len(x) * k, model.n)),
                "deviation": pa.array(model.deviation(x), pa.int64()).take(each),
                "whitened": pa.array(model.project(x).ravel()),
                "explained": pa.array(np.tile(explained, len(x))),
                "identity_error": pa.array(np.full(len(x) * k, model.identity_error))})

    return points.mapInArrow(rows, schema)


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """Fits on all usable rows and projects each of them."""
    points, width = grid_points(embeddings, id_col, vec_col)
    return project(points, width, fit(points, width, components) if width else None)
