"""Operator 13: whitening of embeddings; components by contour integration (see ``feast``).

Entries become integers (``floor(scale * c) + shift``), so that counts and
sums are exact.  The fit list is each distinct integer vector once.  Tasks
sum over their part of it; Spark adds the parts; the driver holds sums, a
covariance and components, which are of the vectors' dimension and do not
grow with their number.  Products are made of centred entries: the integer
part of the mean is taken off exactly, then its fraction.

Cases: rows whose vector is null or empty, or holds a null or non-finite
entry, are left out, as are rows whose vector has another length than most
(the shorter on a tie); entries beyond 2^53 after scaling are held there;
vectors that repeat, under one id or several, are fitted once and each
whitened; components of no variance (below rounding) are not returned, so that
one distinct vector has none; a deviation beyond the range of a long is null;
other columns are passed through; no rows: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmonia.llm.common import cut, fresh
from harmonia.llm.feast import leading_pairs

LIMIT = 1 << 53


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: what every row needs, all of it of the vectors' dimension."""
    dim: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float | None

    @property
    def base(self) -> np.ndarray:
        """Integer part of the mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def fraction(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.fraction

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n * x - S)^2``, exact."""
        off, rest = x - self.base, [s % self.n for s in self.sums]
        most = (int(np.abs(off).max(initial=0)) + 1) * self.n
        if most * most * max(self.dim, 1) < 1 << 63:
            got = ((off * self.n - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        else:
            got = [sum((int(o) * self.n - r) ** 2 for o, r in zip(row, rest)) for row in off]
        return [g if g < 1 << 63 else None for g in got]


def integer_vectors(df: DataFrame, vector: str, to: str, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """The rows with a usable vector, with its integer form in ``to``."""
    sound = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    scaled = F.transform(vector, lambda c: F.least(F.greatest(c.cast("double") * scale, F.lit(float(-LIMIT))),
                                                   F.lit(float(LIMIT))))
    return df.filter(sound).withColumn(to, F.transform(scaled, lambda c: F.floor(c).cast("bigint") + shift))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _added(batches: Iterator[pa.RecordBatch], part: Callable[[pa.Array], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row: the sum of what ``part`` makes of each batch; none without rows."""
    total = None
    for batch in batches:
        if batch.num_rows:
            got = part(batch.column(0))
            total = got if total is None else total + got
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["v"])


def _summed(fit_list: DataFrame, part: Callable[[np.ndarray], np.ndarray], dim: int) -> np.ndarray:
    """The sum over all vectors of what ``part`` makes of a batch.

    A task hands on one row; as many tasks as the root of their number add
    those rows up, and one task adds what these found."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _added(batches, lambda c: c.flatten().to_numpy().reshape(len(c), -1).sum(axis=0))

    parts = fit_list.mapInArrow(lambda b: _added(b, lambda c: part(_matrix(c, dim)).ravel()), "v array<double>")
    few = math.isqrt(max(1, fit_list.rdd.getNumPartitions()))
    got = parts.repartition(few).mapInArrow(add, "v array<double>").repartition(1).mapInArrow(add, "v array<double>").first()
    return np.array(got["v"])


def _count_and_sums(fit_list: DataFrame, dim: int) -> tuple[int, tuple[int, ...]]:
    """Exact count and sums: integers within tasks, decimals across them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (dim + 1)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            if int(np.abs(x).max(initial=0)) * max(len(x), 1) >= 1 << 62:
                x = x.astype(object)
            total = [t + int(s) for t, s in zip(total, [*x.sum(axis=0), len(x)])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim + 1), pa.int64()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["k", "v"])

    rows = dict(fit_list.mapInArrow(run, "k long, v decimal(38,0)").groupBy("k").agg(F.sum("v")).collect())
    return int(rows.get(dim, 0)), tuple(int(rows.get(i, 0)) for i in range(dim))


def fit(df: DataFrame, vector: str = "embedding", components: int = 16, scale: int = 64,
        shift: int = 1_000_000) -> Whitening:
    """Fits the whitening on each distinct integer vector of ``df`` once."""
    x = integer_vectors(df.select(F.col(vector).alias("v")), "v", "x", scale, shift).select("x")
    most = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if most is None:
        return Whitening(0, 0, (), np.zeros(0), np.zeros((0, 0)), np.zeros(0), None)
    dim = most["d"]
    fit_list = cut(x.filter(F.size("x") == dim).distinct())
    n, sums = _count_and_sums(fit_list, dim)
    bare = Whitening(dim, n, sums, np.zeros(0), np.zeros((dim, 0)), np.zeros(0), None)

    def products(batch: np.ndarray) -> np.ndarray:
        c = bare.centred(batch)
        return c.T @ c

    covariance = _summed(fit_list, products, dim).reshape(dim, dim) / n
    values, vectors = leading_pairs(covariance, components)
    explained = values / np.trace(covariance) if len(values) else values
    model = Whitening(dim, n, sums, values, vectors, explained, None)
    if not len(values):
        return model
    k = len(values)

    def moments(batch: np.ndarray) -> np.ndarray:
        w = np.column_stack((model.project(batch), np.ones(len(batch))))
        return w.T @ w

    got = _summed(fit_list, moments, dim).reshape(k + 1, k + 1)
    mean = got[k, :k] / n
    error = np.abs(got[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max()
    return Whitening(dim, n, sums, values, vectors, explained, float(error))


def whiten(df: DataFrame, model: Whitening, vector: str = "embedding", scale: int = 64,
           shift: int = 1_000_000) -> DataFrame:
    """The rows of ``df`` with a usable vector, with ``deviation`` and ``whitened``
    (one double per component); columns of these names are replaced."""
    x, both = fresh(df, "_x"), fresh(df, "_both")

    @F.arrow_udf("struct<deviation: long, whitened: array<double>>")
    def project(column: pa.Array) -> pa.Array:
        m = _matrix(column, model.dim)
        w = model.project(m)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
        return pa.StructArray.from_arrays([pa.array(model.deviations(m), pa.int64()), lists], ["deviation", "whitened"])

    rows = integer_vectors(df, vector, x, scale, shift).filter(F.size(x) == model.dim)
    rows = rows.withColumn(both, project(F.col(x)))
    return rows.withColumns({"deviation": F.col(f"{both}.deviation"), "whitened": F.col(f"{both}.whitened")}).drop(x, both)


def component_rows(whitened: DataFrame, model: Whitening, vec_id: str = "vec_id") -> DataFrame:
    """One row per vector and component: its number from 1, the exact deviation,
    the whitened value and the fit's figures."""
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    return (whitened.select(vec_id, "deviation", F.posexplode("whitened").alias("at", "value"))
            .select(vec_id, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
                    F.col("value").alias("whitened"), F.get(explained, F.col("at")).alias("explained"),
                    F.lit(model.identity_error).cast("double").alias("identity_error")))
