"""Support vectors with a radial kernel, by a map that makes the kernel an inner product.

exp(-gamma * |a - b|^2) is the mean of cos(w.a + p) * cos(w.b + p) * 2 over normal w and uniform p. With a fixed number
of hashed draws each row becomes a vector of that many cosines, once and by itself, and a linear classifier on these
is a kernel classifier on the rows: no table of all pairs. The error of a kernel value falls with the root of the
draws, whatever the rows; `kernel_error` measures it on a few.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.models.trees import _rows, unit
from larkspur.operators.neighbors import _vec


def scale_gamma(df: DataFrame, feats) -> float:
    """1 / (columns * variance of all entries), the usual default."""
    x = F.explode(F.col("x"))
    got = df.select(_vec(df, feats).alias("x")).select(F.size("x").alias("k"), x.alias("v")).agg(F.max("k").alias("k"), F.var_pop("v").alias("v")).first()
    return 1.0 / (got["k"] * got["v"]) if got["k"] and got["v"] else 1.0


@dataclass(frozen=True)
class FourierMap:
    """`draws` cosines of hashed frequencies; holds width * draws numbers."""

    width: int
    gamma: float
    draws: int = 1024
    seed: int = 42

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        j, d = np.arange(self.width)[:, None], np.arange(self.draws)[None, :]
        u, v = unit(self.seed, 21, j, d), unit(self.seed, 22, j, d)
        w = np.sqrt(-2 * np.log(1 - u)) * np.cos(2 * np.pi * v) * np.sqrt(2 * self.gamma)
        return w, 2 * np.pi * unit(self.seed, 23, d[0])

    def apply(self, x: np.ndarray) -> np.ndarray:
        w, p = self.parts()
        return np.sqrt(2 / self.draws) * np.cos(x @ w + p)

    def column(self, x: Column) -> Column:
        w, p = self.parts()
        draws = self.draws

        @F.arrow_udf("array<double>")
        def run(col: pa.Array) -> pa.Array:
            z = np.sqrt(2 / draws) * np.cos(_rows(col) @ w + p) if len(col) else np.empty((0, draws))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(col) + 1) * draws, pa.int32()), pa.array(z.ravel()))

        return array_to_vector(run(x))


def kernel_error(mapped: FourierMap, x: np.ndarray) -> tuple[float, float]:
    """Mean and greatest absolute error of the kernel over all pairs of a few rows."""
    z = mapped.apply(x)
    exact = np.exp(-mapped.gamma * ((x[:, None] - x[None]) ** 2).sum(2))
    off = np.abs(z @ z.T - exact)
    return float(off.mean()), float(off.max())


@dataclass
class KernelSvc:
    mapped: FourierMap
    model: LinearSVCModel
    feats: str | list

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df.withColumn("_z", self.mapped.column(_vec(df, self.feats))))
        return out.select(*df.columns, "rawPrediction", "prediction")


def fit_kernel_svc(df: DataFrame, feats, label: str, C: float = 1.0, gamma: float | None = None, draws: int = 1024, rounds: int = 100, seed: int = 42) -> KernelSvc:
    """A radial-kernel classifier of labels 0 and 1. Rows are mapped once and held while the solver reads them."""
    width = df.select(F.size(_vec(df, feats)).alias("k")).first()
    if width is None:
        raise ValueError("no rows to learn from")
    mapped = FourierMap(width["k"], scale_gamma(df, feats) if gamma is None else gamma, draws, seed)
    rows = df.select(F.col(label).cast("double").alias("_y"), mapped.column(_vec(df, feats)).alias("_z")).cache()
    try:
        svc = LinearSVC(labelCol="_y", featuresCol="_z", regParam=1.0 / (C * rows.count()), standardization=False, maxIter=rounds)
        return KernelSvc(mapped, svc.fit(rows), feats)
    finally:
        rows.unpersist()
