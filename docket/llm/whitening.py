"""Embedding whitening (operator 11): two-pass covariance, symmetric eigenvectors, broadcast projection.

The fit list, each distinct whole-number vector once, is a written table. Its exact
integer sums give the mean. A second pass sums the outer products of the centred
vectors, a matrix product per batch; treeAggregate merges the tasks' matrices, so that
the driver meets a few of them only. LAPACK's symmetric solver gives the components;
their projection is broadcast, as large as the vectors' dimension, whatever the number
of rows. A last pass over the fit list measures the covariance of what comes out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, tree_sum, written

#: Numbers from here on don't fit into what 64 bits hold when the mean is taken off.
LARGEST = float(2**62)


@dataclass(frozen=True)
class Settings:
    scale: float = 64.0
    shift: int = 1_000_000
    components: int = 16  # at most
    least: float = 1e-12  # eigenvalues below this share of the largest are taken for zero


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives. projection: dim x components, scaled to unit variance; zero columns where there is no variance."""

    n: int
    sums: tuple[int, ...]
    projection: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean, whose whole part is taken off exactly."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - base).astype(np.float64) - rest

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.projection

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - S) squared; None beyond 64 bits."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        off = x - base
        about = ((off.astype(np.float64) * self.n - rest) ** 2).sum(1)
        fits = about < 9.2e18  # every part then fits 64 bits too
        t = np.where(fits[:, None], off, 0) * self.n - np.where(fits[:, None], rest, 0)
        out: list[int | None] = (t * t).sum(1).tolist()
        for i in np.flatnonzero(~fits):
            whole = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[i].tolist(), self.sums, strict=True)) if about[i] < 9.3e18 else 2**63
            out[i] = whole if whole < 2**63 else None
        return out


def whole_numbers(vector: Column, s: Settings) -> Column:
    """Whole numbers of the components; null for vectors that take no part."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) * s.scale >= LARGEST))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(s.scale)) + F.lit(s.shift)))


def trimmed(x: Column, s: Settings) -> Column:
    """A vector without zeros at its end, so that vectors which differ by these alone are one."""
    last = F.array_max(F.transform(x, lambda v, i: F.when(v != s.shift, i + 1).otherwise(0)))
    return F.slice(x, 1, F.coalesce(last, F.lit(0)))


def rows_of(column: pa.ChunkedArray | pa.Array, dim: int, fill: int) -> np.ndarray:
    """Lists as a matrix of dim columns, short ones filled up."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    out = np.full((len(column), dim), fill, np.int64)
    out[np.arange(dim)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _sums(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """One row of whole numbers as text: n, then the sums of what is beyond shift; 64 bits might not hold them."""
    n, total = 0, []
    for b in batches:
        if b.num_rows:
            x = rows_of(b.column("x"), int(max(b.column("size").to_numpy().max(), 0)), s.shift) - s.shift
            n += len(x)
            high, low = (x >> 31).sum(0).tolist(), (x & (2**31 - 1)).sum(0).tolist()  # each is exact for 2^32 rows
            total += [0] * (len(high) - len(total))
            for k, (h, lo) in enumerate(zip(high, low, strict=True)):
                total[k] += (h << 31) + lo
    yield pa.RecordBatch.from_arrays([pa.array([[str(v) for v in (n, *total)]], pa.list_(pa.string()))], ["sums"])


def _add(a: list[int], b: list[int]) -> list[int]:
    long, short = (a, b) if len(a) >= len(b) else (b, a)
    return [v + (short[k] if k < len(short) else 0) for k, v in enumerate(long)]


def fit(vectors: DataFrame, s: Settings = Settings(), vector_col: str = "embedding") -> Whitening | None:  # noqa: B008
    """Components of the vectors' covariance over each distinct whole-number vector once; None if there is no vector with a component.

    Vectors that are null, hold null or non-finite entries, or entries that 64 bits can't hold, are left out; short ones count as filled up with zeros.
    """
    small_batches(vectors.sparkSession)
    whole = vectors.select(whole_numbers(F.col(vector_col), s).alias("x")).where("x is not null")
    listed = written(whole.select(trimmed(F.col("x"), s).alias("x"), F.size("x").alias("size")).groupBy("x").agg(F.max("size").alias("size")), "whitening-fit")
    counted = listed.mapInArrow(lambda b: _sums(b, s), "sums array<string>").rdd.map(lambda r: [int(v) for v in r[0]])
    n, *sums = counted.treeAggregate([0], _add, _add, depth=2)
    dim = len(sums)
    if not n or not dim:
        return None
    sums = tuple(v + n * s.shift for v in sums)
    model = Whitening(n, sums, np.zeros((dim, 0)), np.zeros(0), 0.0)

    def products(of) -> np.ndarray:  # noqa: ANN001
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: np.ndarray | float = 0.0
            for b in batches:
                if b.num_rows:
                    y = of(rows_of(b.column("x"), dim, s.shift))
                    total = total + y.T @ y
            if not isinstance(total, float):
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

        flat = tree_sum(listed.mapInArrow(run, "m binary"), "m")
        size = int(round(len(flat) ** 0.5))
        return flat.reshape(size, size) / n

    cov = products(model.centred)
    values, vectors_ = np.linalg.eigh((cov + cov.T) / 2)
    k = min(s.components, dim)
    values, directions = np.maximum(values[::-1][:k], 0), vectors_[:, ::-1][:, :k]
    lead = directions[np.abs(directions).argmax(0), np.arange(k)]
    directions = directions * np.where(lead < 0, -1.0, 1.0)
    real = values > s.least * max(values[0], 0)
    scaled = np.where(real, directions / np.sqrt(np.where(real, values, 1.0)), 0.0)
    model = Whitening(n, sums, scaled, np.where(real, values, 0.0), float(np.trace(cov)))
    if not real.any():
        return model
    left = products(model.project)[np.ix_(real, real)] - np.eye(int(real.sum()))
    return Whitening(n, sums, scaled, model.eigenvalues, model.trace, float(np.abs(left).max()))


def whiten(vectors: DataFrame, model: Whitening | None, s: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:  # noqa: B008
    """(id, deviation, whitened) of every row whose vector takes part: its exact squared deviation and its components.

    A component without variance is null, a deviation beyond 64 bits too. Null ids stay, repeated rows are all there, empty tables
    and tables without any usable vector give no rows; other columns aren't looked at. Vectors longer than the model's lose their end.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), whole_numbers(F.col(vector_col), s).alias("x")).where("x is not null")
    if model is None:
        return rows.where("false").select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    shared, dim = spark.sparkContext.broadcast(model), len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        gone = np.flatnonzero(m.eigenvalues == 0)
        for b in batches:
            x = rows_of(b.column("x"), dim, s.shift)
            y = m.project(x)
            mask = np.zeros(y.shape, bool)
            mask[:, gone] = True
            flat = pa.array(y.ravel(), mask=mask.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * y.shape[1]), flat)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(m.deviations(x), pa.int64()), lists], ["id", "deviation", "whitened"])

    rows = rows.withColumn("x", F.slice("x", 1, dim))
    return rows.mapInArrow(run, f"id {kind}, deviation long, whitened array<double>").withColumnRenamed("id", id_col)


def components(vectors: DataFrame, s: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:  # noqa: B008
    """(id, component, n, deviation, whitened, explained, identity_error): a row per usable vector and component.

    Fitted on the table itself. explained is null where nothing varies, identity_error then too; the rest as in whiten and fit.
    """
    model = fit(vectors, s, vector_col)
    n, trace = (model.n, model.trace) if model else (0, 0.0)
    shares = [float(e / trace) if trace > 0 else None for e in model.eigenvalues] if model else []
    error = F.lit(model.identity_error if model else None).cast("double")
    known = F.array(*map(F.lit, shares)).cast("array<double>")
    out = whiten(vectors, model, s, id_col, vector_col).select(id_col, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(id_col, (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(known, F.col("at")).alias("explained"), error.alias("identity_error"))
