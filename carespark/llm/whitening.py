"""Whitening of embeddings, fitted on distinct vectors with their counts.

1. Every vector becomes whole numbers x; equal ones are grouped, and from here
   on a distinct vector stands for its rows, with their count (or one, see ``counts``) as its weight.
2. Sums and the weighted covariance (centred before multiplying) are added up
   per task as matrix products over batches, and across tasks by Spark; what reaches the driver is
   one dims x dims matrix, whose size the rows don't touch.
3. The covariance's eigenvectors (by falling eigenvalue, their largest entry positive) are the components.
   Every distinct vector is whitened once, and a second weighted covariance, of what came out, tells how far it is from the identity.
4. The results are joined back to the rows on the vector; vectors with a large share
   of the rows (at most 1,000, whatever the size) are broadcast, so none of them
   meets in one task.

Defined cases: vectors that are null, empty or hold null, NaN or infinite
entries, or entries beyond what a long holds once scaled, take no part; neither do
vectors of another length than the most frequent one (ties: the longer); null
and repeated ids keep their rows; components whose eigenvalue is zero up to rounding are left out,
so rows that are all equal, a single row and an empty table give no rows; an exact ``deviation`` beyond a
long raises an error; further columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespark.operators.skew import heavy, spread_lookup

from .common import saved, table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Eigenvalues below this share of the largest are rounding.
TINY = 1e-12
_LIMIT = float(1 << 53)


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """id, x: the vectors that take part, as whole numbers floor(scale * c) + shift."""
    c = F.transform(F.col(vector), lambda v: v.cast("double"))
    fine = F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * scale) < F.lit(_LIMIT)))
    out = rows.select(F.col(key).cast("long").alias("id"), c.alias("c")).where(F.col("c").isNotNull() & (F.size("c") > 0)).where(F.coalesce(fine, F.lit(False)))
    return out.select("id", F.transform("c", lambda v: F.floor(v * scale).cast("long") + shift).alias("x"))


def distinct_vectors(rows: DataFrame, counts: bool = True) -> DataFrame:
    """x, rows, w: every distinct vector with its number of rows and its weight in the fit."""
    out = rows.groupBy("x").agg(F.count("*").alias("rows"))
    return out.withColumn("w", F.col("rows") if counts else F.lit(1).cast("long"))


def _matrix(column: pa.Array, kind: type, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dims)


def _added(vectors: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], size: int, kind: str) -> np.ndarray:
    """The sum over all rows of an array of ``size`` numbers per batch: one array a task, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            here = part(batch)
            total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(size), pa.int32()), "v": pa.array(total.reshape(size))})

    found = vectors.mapInArrow(run, f"at int, v {kind}").groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)") if kind == "long" else "v").alias("v"))
    out = {r.at: r.v for r in found.collect()}  # as many rows as a vector (or the covariance) has entries
    return np.array([int(out[i]) if kind == "long" else out[i] for i in range(size)], object if kind == "long" else float)


@dataclass
class Whitening:
    """What a fit knows: n and S of the fit list, its covariance, components (rows of ``axes``) and their eigenvalues."""

    n: int
    sums: np.ndarray
    covariance: np.ndarray
    axes: np.ndarray
    values: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        return x * np.int64(self.n) - self.sums.astype(np.int64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) / self.n) @ self.axes.T / np.sqrt(self.values)

    @property
    def explained(self) -> list[float]:
        return (self.values / np.trace(self.covariance)).tolist()


def _covariance(vectors: DataFrame, centre: Callable[[pa.RecordBatch], np.ndarray], n: int, dims: int) -> np.ndarray:
    def product(batch: pa.RecordBatch) -> np.ndarray:
        y = centre(batch)
        return y.T @ (y * batch.column("w").to_numpy()[:, None])

    return _added(vectors, product, dims * dims, "double").reshape(dims, dims) / n


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors (x, w), all of one length; None without any or without variance."""
    first = vectors.select(F.size("x").alias("dims")).first()
    if first is None:
        return None
    dims = first.dims
    n = vectors.agg(F.sum("w")).first()[0]
    sums = _added(vectors, lambda b: (_matrix(b.column("x"), np.int64, dims) * b.column("w").to_numpy()[:, None]).sum(0), dims, "long")
    model = Whitening(n, sums, np.zeros((dims, dims)), np.zeros((0, dims)), np.zeros(0))
    model.covariance = _covariance(vectors, lambda b: model.centred(_matrix(b.column("x"), np.int64, dims)) / n, n, dims)
    values, axes = np.linalg.eigh((model.covariance + model.covariance.T) / 2)
    values, axes = values[::-1], axes[:, ::-1].T
    real = np.flatnonzero(values > max(values[0], 0) * TINY * dims)[:components]
    if not len(real):
        return None
    axes = axes[real]
    largest = axes[np.arange(len(axes)), np.abs(axes).argmax(1)]
    model.axes, model.values = axes * np.sign(largest)[:, None], values[real]
    return model


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vectors (x, rows, w) with ``y``, the whitened vector, and ``deviation``, the exact sum of (n*x-S)^2."""
    dims = model.axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), np.int64, dims)
            far = model.centred(x)
            if len(far) and np.square(far.astype(float)).sum(1).max() > 9.2e18:
                raise OverflowError("a deviation doesn't fit a long")
            y = model.whitened(x)
            held = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32()), pa.array(y.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, held, pa.array(np.square(far).sum(1))], [*batch.schema.names, "y", "deviation"])

    return vectors.mapInArrow(run, "x array<long>, rows long, w long, y array<double>, deviation long")


def identity_error(whitened: DataFrame, n: int, components: int) -> float:
    """The largest absolute entry of the whitened vectors' weighted covariance minus the identity."""
    part = lambda b: (_matrix(b.column("y"), float, components) * b.column("w").to_numpy()[:, None]).sum(0)
    mean = _added(whitened, part, components, "double") / n
    covariance = _covariance(whitened, lambda b: _matrix(b.column("y"), float, components) - mean, n, components)
    return float(np.abs(covariance - np.eye(components)).max())


def whitened_rows(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, counts: bool = True) -> DataFrame:
    """id, n, deviation, y (whitened), and the fit's explained shares and identity error, per row that takes part."""
    spark = rows.sparkSession
    placed = saved(whole_vectors(rows, key, vector), "whole-vectors")
    sizes = placed.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    schema = "id long, n long, deviation long, y array<double>, explained array<double>, identity_error double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    placed = placed.where(F.size("x") == sizes.dims)
    vectors = saved(distinct_vectors(placed, counts), "distinct-vectors")
    model = fit(vectors, components)
    if model is None:
        return spark.createDataFrame([], schema)
    whitened = saved(whiten(vectors, model), "whitened-vectors")
    error = identity_error(whitened, model.n, len(model.values))
    out = spread_lookup(placed, whitened, "x", heavy(F.col("rows"), sizes["count"]))
    return out.select("id", F.lit(model.n).cast("long").alias("n"), "deviation", "y",
                      F.array(*map(F.lit, model.explained)).alias("explained"), F.lit(error).alias("identity_error"))


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    out = whitened_rows(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    out = out.select("id", "n", "deviation", "explained", "identity_error", F.posexplode("y").alias("at", "whitened"))
    return out.select(F.col("id").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                      F.get("explained", "at").alias("explained"), "identity_error")
