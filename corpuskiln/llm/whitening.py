"""Whitening of vectors: exact integer sums, a second pass of centred outer products, LAPACK, a broadcast projection."""

from __future__ import annotations

import operator
import pickle
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

COMPONENTS = 32
#: A component c is the integer floor(SCALE * c) + SHIFT; |SCALE * c| stays under 2**46, so that it is exact in double precision.
SCALE, SHIFT, LARGEST = 64, 1_000_000, float(1 << 46)
#: Rows of a block that are multiplied at once.
BLOCK = 2048
#: Components with less than this share of the largest eigenvalue have no variance that double precision could scale to 1.
LEAST_SHARE = 1e-11

#: Partial results by dimension: number of vectors and an array that is added.
Partial = dict[int, tuple[int, np.ndarray]]


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, without null or non-finite components, and none that outgrows exact integers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * F.lit(float(SCALE))) >= LARGEST))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def integers(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and their integer vectors, a dimension and a block of rows at a time."""
    vectors = batch.column(column)
    ends = np.asarray(vectors.offsets, np.int64)
    values = np.asarray(vectors.values, np.float64)
    sizes = np.diff(ends)
    for d in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == d)
        for at in range(0, len(rows), BLOCK):
            some = rows[at : at + BLOCK]
            yield some, (np.floor(values[ends[some][:, None] + np.arange(d)] * SCALE)).astype(np.int64) + SHIFT


def _summed(rows: DataFrame, of_block: Callable[[np.ndarray], np.ndarray]) -> Partial:
    """``of_block`` summed over all blocks by dimension: a row per task, merged in a tree of tasks, so the driver gets a few arrays."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Partial = {}
        for batch in batches:
            for _, x in integers(batch, 0):
                _add(found, {x.shape[1]: (len(x), of_block(x))})
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], ["partial"])

    parts = rows.select("vector").mapInArrow(partial, "partial binary").rdd.map(lambda r: pickle.loads(r["partial"]))
    return parts.treeAggregate({}, _add, _add, 3)


def _add(left: Partial, right: Partial) -> Partial:
    for d, (n, a) in right.items():
        known = left.get(d)
        left[d] = (n, a) if known is None else (known[0] + n, operator.add(known[1], a))
    return left


class Fit(NamedTuple):
    """What one dimension's vectors were fitted to: their number, exact sums as Python integers, the projection (components in columns), variances and shares."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n``: the whole part of the mean goes exactly, only the rest is rounded."""
        whole = np.array([s // self.n for s in self.sums])
        return (x - whole).astype(np.float64) - np.array([s % self.n for s in self.sums]) / self.n

    def scaled(self) -> np.ndarray:
        """The projection over the standard deviations; NaN where there is no variance."""
        ok = self.variances > LEAST_SHARE * max(self.variances.max(initial=0.0), 0.0)
        return self.axes / np.sqrt(np.where(ok, self.variances, np.nan))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - sums)^2 of each row, exact; null where it outgrows a long."""
        whole = np.array([s // self.n for s in self.sums])
        rest = np.array([s % self.n for s in self.sums], object)
        away = (x - whole).astype(object) * self.n - rest if self.n * int(np.abs(x - whole).max(initial=0)) + self.n >= 1 << 31 else None
        if away is None:
            away = (x - whole) * self.n - rest.astype(np.int64)
            if int(np.abs(away).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
                return (away * away).sum(axis=1).tolist()
            away = away.astype(object)
        return [v if v < 1 << 63 else None for v in (away * away).sum(axis=1).tolist()]


def fit(rows: DataFrame, components: int) -> dict[int, Fit]:
    """A fit for each dimension of ``rows`` (column ``vector``, all usable), from three passes over all of them."""
    sums = _summed(rows, lambda x: x.sum(axis=0).astype(object))
    fits = {d: Fit(n, [int(s) for s in total], np.zeros((d, 0)), np.zeros(0), np.zeros(0), 0.0) for d, (n, total) in sums.items()}

    def outer(x: np.ndarray) -> np.ndarray:
        c = fits[x.shape[1]].centred(x)
        return c.T @ c

    for d, (n, products) in _summed(rows, outer).items():
        values, vectors = np.linalg.eigh((products + products.T) / (2 * n))
        values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
        sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(d)])
        trace = values.sum()
        shares = values / trace if trace > 0 else np.full(d, np.nan)
        fits[d] = fits[d]._replace(axes=(vectors * sign)[:, :components], variances=values[:components], explained=shares[:components])

    def whitened(x: np.ndarray) -> np.ndarray:
        one = fits[x.shape[1]]
        w = one.centred(x) @ np.nan_to_num(one.scaled())
        return w.T @ w

    for d, (n, products) in _summed(rows, whitened).items():
        live = ~np.isnan(fits[d].scaled()).any(axis=0)
        error = np.abs(products / n - np.eye(len(products)))[np.ix_(live, live)]
        fits[d] = fits[d]._replace(identity_error=float(error.max(initial=0.0)))
    return fits


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component up to ``components``: key, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, has null or non-finite components, or one of 2**40 and more, have no rows. Vectors of another
    dimension are another fit list with its own n and components; empty ones have no components. The first pass sums integers, so the mean is exact whatever the order of
    tasks; the second sums outer products of centred vectors, the third those of whitened ones, from which the largest departure
    from the identity is taken. Of a component without variance ``whitened`` is null, and it takes no part in that departure;
    ``explained`` is null where no component has any. Signs: the entry of largest size of each component is positive. What goes to the
    driver is a matrix per dimension, what is sent to tasks a projection; no rows give no rows.
    """
    rows = vectors.select(F.col(key).alias("key"), F.col(column).cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")))
    fits = fit(rows, components)
    kind = vectors.schema[key].dataType
    schema = StructType([StructField(key, kind)]).simpleString()[7:-1] + ",component:int,n:bigint,deviation:bigint,whitened:double,explained:double,identity_error:double"
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, x in integers(batch, 1):
                one = fits[x.shape[1]]
                w, k = one.centred(x) @ one.scaled(), one.axes.shape[1]
                m = w.size
                repeat = np.repeat(np.arange(len(some)), k)
                columns = [
                    batch.column(0).take(pa.array(some[repeat])),
                    pa.array(np.tile(np.arange(1, k + 1), len(some)), pa.int32()),
                    pa.array(np.full(m, one.n), pa.int64()),
                    pa.array(one.deviation(x), pa.int64()).take(pa.array(repeat)),
                    pa.array(w.ravel(), pa.float64(), from_pandas=True),  # NaN is null
                    pa.array(np.tile(one.explained, len(some)), pa.float64(), from_pandas=True),
                    pa.array(np.full(m, one.identity_error), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(project, schema)
