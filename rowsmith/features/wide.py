"""Principal axes of vectors with very many columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from rowsmith.features.base import FitStep, Settings, flag, integer, number, text
from rowsmith.features.numeric import FittedAxes
from rowsmith.session import discard, materialise, written_since

SPARE = 8  # search directions beyond the wanted ones
BLOCK_NUMBERS = 1 << 20  # numbers of a dense block of rows
ROOMS = 8  # blocks the search space holds before it is restarted


class _WideParams(Settings):
    inputCol = text("inputCol", "vector column")
    outputCol = text("outputCol", "vector of components")
    k = integer("k", "components")
    scale = flag("scale")
    seed = integer("seed")
    tolerance = number("tolerance", "largest residual of an axis, in shares of the whole variance")
    passes = integer("passes", "passes over the rows after which the fit is given up")
    defaults = {"outputCol": "pca", "scale": True, "k": 10, "seed": 42, "tolerance": 1e-8, "passes": 200}


class FittedWideAxes(_WideParams, FittedAxes):
    """State: shares of the axes. Table ``axes``: one row per input column with its mean, unit and loadings."""

    def matrix(self) -> tuple[np.ndarray, np.ndarray]:
        """Loadings by column, divided by the column's unit, and the projected mean."""
        axes = self.tables["axes"].orderBy("i").toArrow()
        load = np.array(axes["loading"].to_pylist(), np.float64) / axes["unit"].to_numpy()[:, None]
        return load, axes["mean"].to_numpy() @ load

    def _transform(self, df: DataFrame) -> DataFrame:
        load, mean = self.matrix()

        @F.pandas_udf("array<double>")
        def project(vectors):
            out = vectors.astype(object)
            known = np.flatnonzero(vectors.notna())
            for i, found in zip(known, (np.stack(vectors.iloc[known].to_list()) @ load - mean) if len(known) else []):
                out.iat[i] = found
            return out

        col = F.col(self.value("inputCol"))
        dense = F.when(col.isNotNull(), vector_to_array(col))
        found = project(dense)
        return df.withColumn(self.value("outputCol"), F.when(found.isNotNull(), array_to_vector(found)))


def _orthogonal(block: np.ndarray, basis: np.ndarray | None, least: float) -> np.ndarray:
    """The directions of ``block`` outside ``basis``, orthonormal; those shorter than ``least`` are rounding and left out."""
    for _ in range(2):
        if basis is not None:
            block = block - basis @ (basis.T @ block)
        left, size, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, size > least]
        least = 1e-8  # the second time the columns have unit length
    return block


def _dense(vectors: pa.StructArray, width: int):
    """Blocks of rows of a column of vectors (their fields: kind, size, indices, values; without indices: dense)."""
    flat = vectors.field("values").flatten().to_numpy(zero_copy_only=False)
    sizes = vectors.field("values").value_lengths().to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    places = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(np.where(sparse, sizes, 0))])
    step = max(1, BLOCK_NUMBERS // width)
    for i in range(0, len(vectors), step):
        part = slice(i, i + step)
        n = len(sizes[part])
        kind = np.repeat(sparse[part], sizes[part])
        at = np.tile(np.arange(width), int((~sparse[part]).sum()))
        column = np.empty(len(kind), np.int64)
        column[kind], column[~kind] = places[starts[i] : starts[i + n]], at
        x = np.zeros((n, width))
        x[np.repeat(np.arange(n), sizes[part]), column] = flat[ends[i] : ends[i + n]]
        yield x


def _turned(axes: np.ndarray) -> np.ndarray:
    """Each axis with its largest loading positive."""
    top = np.abs(axes).argmax(axis=0)
    return axes * np.where(axes[top, np.arange(axes.shape[1])] < 0, -1.0, 1.0)


class WideAxes(FitStep, _WideParams):
    """The ``k`` main axes of a vector column without its matrix of covariances.

    The same axes and shares as ``PrincipalAxes`` (vectors are centred and, with ``scale``, divided by the population
    deviation), for columns by the ten thousand. A random start block is multiplied again and again by the covariance:
    each product is one pass over the rows, in which a task adds up ``columns x block`` numbers. The driver holds the search space,
    at most ``columns x (k + 8) x 9`` numbers and as many products, and restarts it from its best axes when it is full.
    The fit ends when every residual is below ``tolerance`` of the whole variance, which bounds the error of a share
    by as much, and raises an error if ``passes`` do not suffice.

    Rows without a vector are left out and get null. Columns that never vary have no loading. There are never more axes
    than directions in which the rows vary.
    """

    model = FittedWideAxes

    def _fit(self, df: DataFrame) -> FittedWideAxes:
        spark, source = df.sparkSession, self.value("inputCol")
        mark = len(written_since())
        rows = materialise(df.select(F.col(source).alias("v")).where(F.col(source).isNotNull()), "vectors")
        if rows.isEmpty():
            raise ValueError("no vectors to fit")
        stats = rows.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s")).select("s.*").first()
        n = stats["count"]
        mean, var = stats["mean"].toArray(), stats["variance"].toArray() * (n - 1) / n
        # A variance this far below the squared mean is rounding of a constant.
        var = np.where(var <= 1e-14 * mean**2, 0.0, var)
        live = var > 0
        unit = np.where(live, np.sqrt(var), 1.0) if self.value("scale") else np.ones_like(var)
        whole = float(live.sum() if self.value("scale") else var.sum())
        d = len(mean)
        k = min(self.value("k"), int(live.sum()))
        if whole <= 0:
            raise ValueError("vectors do not vary")
        width = min(k + SPARE, int(live.sum()))

        def times(block: np.ndarray) -> np.ndarray:
            """Covariance times ``block``, summed over the tasks."""
            inner = np.where(live, 1.0 / unit, 0.0)[:, None] * block
            size = block.shape[1]

            def add(batches):
                total = np.zeros((d, size))
                for batch in batches:
                    for x in _dense(batch.column(0), d):
                        x -= mean
                        total += x.T @ (x @ inner)
                flat = pa.array(total.ravel())
                offsets = pa.array(np.arange(0, d * size + 1, size, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.ListArray.from_arrays(offsets, flat)], ["i", "g"])

            parts = rows.select(F.unwrap_udt("v").alias("x")).mapInArrow(add, "i int, g array<double>")
            sums = parts.groupBy("i").agg(F.array(*[F.sum(F.get("g", F.lit(j))) for j in range(size)]).alias("g")).toArrow()
            out = np.zeros((d, size))
            out[sums["i"].to_numpy()] = sums["g"].combine_chunks().flatten().to_numpy().reshape(-1, size)
            return np.where(live, 1.0 / unit, 0.0)[:, None] * out / n

        start = np.random.default_rng(self.value("seed")).standard_normal((d, width)) * live[:, None]
        fresh = _orthogonal(start, None, 0.0)
        basis = products = np.zeros((d, 0))
        for _ in range(self.value("passes")):
            basis, products = np.hstack([basis, fresh]), np.hstack([products, times(fresh)])
            small = basis.T @ products
            value, turn = np.linalg.eigh((small + small.T) / 2)
            value, turn = value[::-1], turn[:, ::-1]
            wanted = min(k, len(value))
            off = products @ turn[:, :width] - (basis @ turn[:, :width]) * value[:width]
            size = np.linalg.norm(off, axis=0)
            # New directions: the product of the newest block, or the residuals after a restart.
            full = basis.shape[1] + width > (ROOMS + 1) * width
            if full:
                basis, products = basis @ turn[:, :width], products @ turn[:, :width]
            later = off if full else products[:, -fresh.shape[1]:]
            fresh = _orthogonal(later, basis, 1e-13 * whole)
            found = (basis[:, :wanted], value[:wanted]) if full else (basis @ turn[:, :wanted], value[:wanted])
            if (size[:wanted] <= self.value("tolerance") * whole).all() or not fresh.shape[1]:
                break
        else:
            raise ValueError(f"axes not found in {self.value('passes')} passes: residual {size[:wanted].max() / whole:.1e} of the variance")
        axes, value = found
        some = value > 1e-12 * whole
        axes, value = _turned(axes[:, some]), value[some]
        table = spark.createDataFrame(
            pa.table({"i": np.arange(d, dtype=np.int32), "mean": mean, "unit": unit,
                      "loading": pa.array(list(axes), pa.list_(pa.float64()))}))
        out = self.fitted({"ratios": [float(v) / whole for v in value], "kept": len(value)}, axes=table)
        discard(written_since(mark)[:1])
        return out
