"""Principal components of a column group (F8).

Spark ML's PCA fits the covariance in a distributed pass (a d x d Gram matrix
per partition, summed); only the d x k components reach the driver.  The
reference centres the data (scikit-learn PCA), Spark's projection does not,
so the columns are centred first with ``StandardScaler(withMean=True,
withStd=False)``.

``fit_pca_wide`` is for tables whose d x d covariance is too large for one machine.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.operators.profile import _chunked_cells
from tabkiln.operators.project import _missing


@dataclass
class PcaResult:
    model: PipelineModel
    columns: list[str]
    k: int

    @property
    def explained_variance(self) -> list[float]:
        return list(self.model.stages[-1].explainedVariance.toArray())

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Every row of ``df``; a row with a missing column has NULL components."""
        complete = _complete(df, self.columns)
        out = self.model.transform(df)
        arr = vector_to_array(F.col("_pca"))
        return out.select(*[F.col(c) for c in keep], *[F.when(complete, arr[i]).alias(f"pca_{i}") for i in range(self.k)])


def _complete(df: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(and_, [~_missing(df, c) for c in cols])


def fit_pca(df: DataFrame, cols: Sequence[str], k: int) -> PcaResult:
    """Centred PCA of ``cols`` with ``k`` components, fitted on the rows without missing values."""
    cols = list(cols)
    if k > len(cols):
        raise ValueError("k cannot exceed the number of columns")
    stages = [
        VectorAssembler(inputCols=cols, outputCol="_pca_in", handleInvalid="keep"),
        StandardScaler(inputCol="_pca_in", outputCol="_pca_c", withMean=True, withStd=False),
        PCA(k=k, inputCol="_pca_c", outputCol="_pca"),
    ]
    model = Pipeline(stages=stages).fit(df.filter(_complete(df, cols)))
    return PcaResult(model, cols, k)


def pca_features(df: DataFrame, cols: Sequence[str], k: int, keep: Sequence[str] = ()) -> tuple[DataFrame, list[float]]:
    """``pca_0..pca_{k-1}`` plus ``keep`` columns, and the explained-variance ratios."""
    res = fit_pca(df, cols, k)
    return res.transform(df, keep), res.explained_variance


# --------------------------------------------------------------------------
# wide tables: randomised range finder
# --------------------------------------------------------------------------

# Columns of the range beyond the components asked for, and passes that sharpen it.
OVERSAMPLE = 10
POWER_PASSES = 4
# Products of a column and a weight that are projected by plain expressions.
PLAIN_TERMS = 256


@dataclass
class WidePca:
    """Components of a wide column group: ``vectors`` is d x k, the largest thing the driver holds."""

    columns: list[str]
    mean: np.ndarray
    vectors: np.ndarray
    variance: np.ndarray
    total_variance: float

    @property
    def explained_variance(self) -> list[float]:
        """Share of the total variance, component by component (0 for a constant table)."""
        return [float(v / self.total_variance) if self.total_variance > 0 else 0.0 for v in self.variance]

    def transform(self, df: DataFrame, keep: Sequence[str] = (), plain_terms: int = PLAIN_TERMS) -> DataFrame:
        """Every row of ``df``; a row with a missing column has NULL components.  Rows stay in their tasks.

        Up to ``plain_terms`` products of a column and a weight are plain
        expressions in generated code; more go through NumPy in Arrow batches,
        since so many expressions would not compile.
        """
        mean, vectors, d = self.mean, self.vectors, len(self.columns)
        inputs = [F.col(f"`{c}`").cast("double") for c in self.columns]
        if vectors.size <= plain_terms:
            complete = reduce(and_, [x.isNotNull() & ~F.isnan(x) for x in inputs])
            scores = [sum(((x - float(m)) * float(w) for x, m, w in zip(inputs, mean, v)), F.lit(0.0)) for v in vectors.T]
            return df.select(*[F.col(f"`{c}`") for c in keep], *[F.when(complete, s).alias(f"pca_{i}") for i, s in enumerate(scores)])

        def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for rows in batches:
                x = np.array(rows.tolist(), dtype=float).reshape(len(rows), d)
                scores = (x - mean) @ vectors
                yield pd.Series([None if np.isnan(s).any() else s for s in scores])

        scores = F.pandas_udf(project, "array<double>")(F.array(*inputs))
        staged = df.select(*[F.col(f"`{c}`") for c in keep], scores.alias("_pca"))
        return staged.select(*[F.col(f"`{c}`") for c in keep], *[F.get("_pca", F.lit(i)).alias(f"pca_{i}") for i in range(vectors.shape[1])])


def _task_products(mean: np.ndarray, basis: np.ndarray):
    """Per task, X'(XQ) for the centred rows X, one row of the product to a column of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(basis)
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - mean
            x = x[~np.isnan(x).any(axis=1)]
            total += x.T @ (x @ basis)
        for start in range(0, len(total), 1024):
            part = total[start : start + 1024]
            at = pa.array(np.arange(start, start + len(part)), pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array(part.tolist(), pa.list_(pa.float64()))], names=["pos", "cells"])

    return run


def fit_pca_wide(
    df: DataFrame,
    cols: Sequence[str],
    k: int,
    seed: int = 17,
    oversample: int = OVERSAMPLE,
    passes: int = POWER_PASSES,
) -> WidePca:
    """Centred PCA with ``k`` components by a randomised range finder (F8).

    A random d x l basis (l = k + ``oversample``) is multiplied by the
    covariance and made orthonormal, once and ``passes`` times more; the
    components come from the l x l covariance inside the last basis.  Each
    product is one scan whose tasks hold a batch and a d x l sum, added by a
    grouped aggregate.  The driver holds d x l numbers, never d x d.

    Exact when l reaches the rank of the centred table (so for any table of at
    most k + ``oversample`` columns); else the error falls with every pass by the
    square of the ratio of the first left-out variance to the k-th.  Fitted on
    the rows without missing values; with fewer than two of them all variances are 0.
    Components are signed so that the largest loading is positive.
    """
    cols = list(cols)
    d = len(cols)
    if not 0 < k <= d:
        raise ValueError("k must be between 1 and the number of columns")
    missing = F.exists(F.array(*[F.col(f"`{c}`").cast("double") for c in cols]), lambda x: x.isNull() | F.isnan(x))
    whole = df.filter(~missing).select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    rows = whole.coalesce(tasks)

    def cell(name: str) -> Column:
        return F.struct(F.lit(int(name[1:])).alias("pos"), F.avg(name).alias("mean"), F.var_samp(name).alias("var"), F.count(name).alias("n"))

    stats = sorted(_chunked_cells(whole, whole.columns, cell, 6).collect(), key=lambda r: r["pos"])
    n = stats[0]["n"]
    mean = np.array([r["mean"] or 0.0 for r in stats])
    total = float(sum(r["var"] or 0.0 for r in stats))
    size = min(d, k + oversample)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, size)))[0]
    if n < 2:
        return WidePca(cols, mean, basis[:, :k], np.zeros(k), 0.0)

    def product(q: np.ndarray) -> np.ndarray:
        parts = rows.mapInArrow(_task_products(mean, q), "pos int, cells array<double>")
        sums = parts.groupBy("pos").agg(F.array(*[F.sum(F.get("cells", F.lit(j))) for j in range(size)]).alias("cells"))
        out = np.zeros_like(q)
        for r in sums.collect():  # d rows of l numbers
            out[r["pos"]] = r["cells"]
        return out / (n - 1)

    for _ in range(passes + 1):
        basis = np.linalg.qr(product(basis))[0]
    inside = basis.T @ product(basis)
    values, turns = np.linalg.eigh((inside + inside.T) / 2)
    order = np.argsort(values)[::-1][:k]
    vectors = basis @ turns[:, order]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(k)]
    return WidePca(cols, mean, vectors * np.where(largest < 0, -1.0, 1.0), np.maximum(values[order], 0.0), total)
