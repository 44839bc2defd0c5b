"""Column profiling, roles and statistics-driven column selection.

A1-A6, A22, C1, C2.  A profile is a one-row aggregate per chunk of
columns, exploded into a long report so it stays a DataFrame.  Chunks keep
each aggregate's buffers under Spark's whole-stage codegen field limit and
run in one job.  Fits that steer a later projection collect the small
report (one row per column) to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from tabkiln.functions import safe_corr

# Correlation pairs per aggregate.  A guarded correlation keeps fourteen
# buffer fields (covariance, two conditional deviations, two ranges); whole-stage
# codegen is switched off for an aggregate whose buffers exceed
# spark.sql.codegen.maxFields (100 by default), so pairs are grouped six at a
# time.  The chunks are unioned into one job, each scan pruned to its columns.
CORR_CHUNK = 6
# Aggregation buffer budget per chunk for the other profiles (same limit).
FIELD_BUDGET = 96


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _chunked_cells(df: DataFrame, items: Sequence, cell, fields_per_item: int) -> DataFrame:
    """Union of one-row aggregates, each over a chunk of ``items`` small enough
    to keep whole-stage codegen, exploded into one row per item.

    Each chunk's scan reads only its own columns: with one column to an item the
    chunks together read what one wide pass would, with pairs a column is read
    once per chunk that holds it.
    """
    size = max(1, FIELD_BUDGET // max(1, fields_per_item))
    out = None
    for start in range(0, len(items), size):
        chunk = items[start : start + size]
        part = df.agg(F.array(*[cell(x) for x in chunk]).alias("cells")).select(F.explode("cells").alias("s")).select("s.*")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("nothing to aggregate")
    return out


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (DoubleType, FloatType))


def _present(df: DataFrame, c: str) -> Column:
    """The column with NaN read as missing in floating columns (pandas semantics)."""
    if _is_float(df, c):
        return F.nanvl(_q(c), F.lit(None).cast(df.schema[c].dataType))
    return _q(c)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


# --------------------------------------------------------------------------
# A1 null profile
# --------------------------------------------------------------------------

def null_profile(df: DataFrame, threshold: float, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, null_frac, rejected)``: rejected when the NULL share is strictly above threshold."""
    cols = list(cols) if cols else df.columns
    out = _chunked_cells(
        df, cols, lambda c: F.struct(F.lit(c).alias("column"), F.avg(_present(df, c).isNull().cast("double")).alias("null_frac")), 2
    )
    return out.withColumn("rejected", F.col("null_frac") > F.lit(float(threshold)))


def rejected_columns(df: DataFrame, threshold: float) -> list[str]:
    return [r["column"] for r in null_profile(df, threshold).filter("rejected").collect()]


# --------------------------------------------------------------------------
# A2 / A3 roles
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class ColumnRoles:
    target: str | None
    categorical: tuple[str, ...]
    non_categorical: tuple[str, ...]
    distinct: dict

    def of(self, categorical: bool) -> list[str]:
        return list(self.categorical if categorical else self.non_categorical)


def distinct_profile(
    df: DataFrame,
    target: str | None,
    threshold: int,
    exclude_float: bool = True,
    approx: bool = False,
) -> DataFrame:
    """``(column, n_distinct, is_float, categorical)`` for every non-target column.

    A column is categorical when it has fewer than ``threshold`` distinct
    non-NULL values and (with ``exclude_float``) is not a floating column.
    ``approx=True`` uses HyperLogLog sketches (mergeable partial aggregates,
    no per-column distinct shuffle) for very wide or very large tables.
    """
    cols = [c for c in df.columns if c != target]
    count = F.approx_count_distinct if approx else F.count_distinct
    wide = df.agg(*[count(_present(df, c)).alias(c) for c in cols])
    long = wide.unpivot([], [_q(c) for c in cols], "column", "n_distinct")
    floats = [c for c in cols if _is_float(df, c)]
    is_float = F.col("column").isin(floats) if floats else F.lit(False)
    cat = F.col("n_distinct") < F.lit(int(threshold))
    if exclude_float:
        cat = cat & ~is_float
    return long.select(
        "column", F.col("n_distinct").cast("long").alias("n_distinct"), is_float.alias("is_float"), cat.alias("categorical")
    )


def column_roles(
    df: DataFrame,
    target: str | None,
    threshold: int,
    exclude_float: bool = True,
    approx: bool = False,
) -> ColumnRoles:
    """Fit the categorical / non-categorical split (A2, A3).

    One pass of sketches tells the columns that are far above the threshold;
    only the others are counted exactly, so that the copies of each row which
    exact counts of several columns take hold few-valued columns alone and
    shrink before the shuffle.  ``distinct`` holds the sketch's estimate for a
    column far above.  ``approx=True`` goes by the sketches alone.
    """
    cols = [c for c in df.columns if c != target]
    rows = distinct_profile(df.select(*map(_q, cols)), None, threshold, exclude_float, approx=True).collect()
    # an estimate (5 % relative deviation) of twice the threshold is ten deviations or more above it
    near = [r["column"] for r in rows if r["n_distinct"] < 2 * threshold + 64]
    if near and not approx:
        exact = distinct_profile(df.select(*map(_q, near)), None, threshold, exclude_float).collect()
        rows = [r for r in rows if r["column"] not in set(near)] + exact
    by_name = {r["column"]: r for r in rows}
    order = [c for c in df.columns if c in by_name]
    return ColumnRoles(
        target=target,
        categorical=tuple(c for c in order if by_name[c]["categorical"]),
        non_categorical=tuple(c for c in order if not by_name[c]["categorical"]),
        distinct={c: by_name[c]["n_distinct"] for c in order},
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(_q(col)).distinct()


# --------------------------------------------------------------------------
# A4 statistics, A5/A6 correlations
# --------------------------------------------------------------------------

def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, mean, min, max)`` in one pass per chunk of columns (A4)."""

    def cell(c: str) -> Column:
        x = _present(df, c).cast("double")
        return F.struct(F.lit(c).alias("column"), F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"))

    return _chunked_cells(df, list(cols), cell, 4)


def fit_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, dict[str, float]]:
    """Driver-side copy of :func:`column_stats` (one row per column)."""
    return {r["column"]: {"mean": r["mean"], "min": r["min"], "max": r["max"]} for r in column_stats(df, cols).collect()}


# A variance below this share of the mean square is rounding noise of a constant.
CONSTANT_SHARE = 1e-12


def correlation_pairs(df: DataFrame, cols: Sequence[str], method: str = "gramian") -> DataFrame:
    """``(col_a, col_b, pos_a, pos_b, corr)`` for every pair a before b (A5).

    Pearson over pairwise complete rows, NULL when a side is constant.
    ``gramian``: one profile of the columns, then one tree-aggregated pass over
    the table for all pairs, whatever their number and their gaps.
    ``aggregate``: plain aggregates, ``CORR_CHUNK`` pairs to a scan; exact for
    the smallest variances, for few columns.
    """
    cols = list(cols)
    pairs = [(i, j) for j in range(len(cols)) for i in range(j)]
    if not pairs:
        raise ValueError("need at least two columns")
    if method == "gramian":
        return _gramian_pairs(df, cols)
    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")

    def cell(pair: tuple[int, int]) -> Column:
        i, j = pair
        return F.struct(
            F.lit(cols[i]).alias("col_a"),
            F.lit(cols[j]).alias("col_b"),
            F.lit(i).alias("pos_a"),
            F.lit(j).alias("pos_b"),
            safe_corr(_q(cols[i]), _q(cols[j])).alias("corr"),
        )

    return _chunked_cells(df, pairs, cell, FIELD_BUDGET // CORR_CHUNK)


def profile_present_counts(df: DataFrame, cols: Sequence[str]) -> dict:
    """Per column: mean, deviation and number of missing values (NULL or NaN), one chunked pass."""

    def cell(c: str) -> Column:
        x = _present(df, c).cast("double")
        missing = F.sum(x.isNull().cast("long"))
        return F.struct(F.lit(c).alias("column"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("sd"), missing.alias("missing"))

    return {r["column"]: r.asDict() for r in _chunked_cells(df, list(cols), cell, 6).collect()}


def _gramian_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every pair's correlation from the Gram matrix of the values, their squares and the masks of present cells.

    Values enter centred and scaled, missing ones as 0; a column without gaps
    has the constant 1 for a mask.  The matrix is bounded by the number of columns.
    """
    present = profile_present_counts(df, cols)
    k = len(cols)
    gaps = [i for i, c in enumerate(cols) if present[c]["missing"]]
    values = []
    for c in cols:
        mean, sd = present[c]["mean"], present[c]["sd"]
        x = (_present(df, c).cast("double") - F.lit(float(mean or 0.0))) * F.lit(1.0 / sd) if sd else F.lit(0.0)
        values.append(F.coalesce(x, F.lit(0.0)))
    parts = [F.lit(1.0), *values]
    if gaps:
        parts += [x * x for x in values] + [_present(df, cols[i]).isNotNull().cast("double") for i in gaps]
    rows = df.select(array_to_vector(F.array(*parts)).alias("v"))
    gram = np.zeros((len(parts), len(parts)))
    if any(present[c]["mean"] is not None for c in cols):  # MLlib refuses a table without rows
        gram = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v"), 0, len(parts)).computeGramianMatrix().toArray()

    value = np.arange(1, k + 1)
    mask = np.zeros(k, int)
    mask[gaps] = 2 * k + 1 + np.arange(len(gaps))
    n = gram[np.ix_(mask, mask)]
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = gram[np.ix_(value, mask)] / n  # of the row's column, over the rows where the other has a value
        square = (gram[np.ix_(value + k, mask)] if gaps else np.diag(gram)[value][:, None]) / n
        var = square - mean * mean
        cov = gram[np.ix_(value, value)] / n - mean * mean.T
        corr = np.clip(cov / np.sqrt(var * var.T), -1.0, 1.0)
        known = (var > CONSTANT_SHARE * square) & (var.T > CONSTANT_SHARE * square.T) & np.isfinite(corr)
    out = [(j, [float(corr[i, j]) if known[i, j] else None for i in range(j)]) for j in range(1, k)]
    names = F.array(*[F.lit(c) for c in cols])
    return (
        df.sparkSession.createDataFrame(out, "pos_b int, corrs array<double>")
        .select("pos_b", F.posexplode("corrs").alias("pos_a", "corr"))
        .select(F.get(names, "pos_a").alias("col_a"), F.get(names, "pos_b").alias("col_b"), "pos_a", "pos_b", "corr")
    )


def target_correlation(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """``(column, corr)``: signed correlation with the target."""
    cell = lambda c: F.struct(F.lit(c).alias("column"), safe_corr(_q(c), _q(target)).alias("corr"))
    return _chunked_cells(df, list(cols), cell, FIELD_BUDGET // CORR_CHUNK)


# --------------------------------------------------------------------------
# C1 / C2 selections
# --------------------------------------------------------------------------

def collinear_report(df: DataFrame, cols: Sequence[str], threshold: float = 0.95, keep: Sequence[str] = ()) -> DataFrame:
    """``(column, dropped)``: a column is dropped when any earlier column has
    ``abs(corr) > threshold`` with it (earlier dropped columns still count).
    Columns in ``keep`` (e.g. the target) are never dropped (C1)."""
    pairs = correlation_pairs(df, cols)
    hit = F.coalesce(F.abs(F.col("corr")) > F.lit(float(threshold)), F.lit(False))
    per_col = pairs.groupBy("col_b").agg(F.max(hit.cast("int")).alias("hit"))
    first = cols[0]
    base = per_col.select(F.col("col_b").alias("column"), (F.col("hit") == 1).alias("dropped"))
    base = base.unionByName(df.sparkSession.range(1).select(F.lit(first).alias("column"), F.lit(False).alias("dropped")))
    if keep:
        base = base.withColumn("dropped", F.col("dropped") & ~F.col("column").isin(list(keep)))
    return base


def fit_collinear(df: DataFrame, cols: Sequence[str], threshold: float = 0.95, keep: Sequence[str] = ()) -> list[str]:
    """Columns to drop."""
    dropped = {r["column"] for r in collinear_report(df, cols, threshold, keep).filter("dropped").collect()}
    return [c for c in cols if c in dropped]


def remove_collinear(df: DataFrame, cols: Sequence[str], threshold: float = 0.95, keep: Sequence[str] = ()) -> DataFrame:
    return df.drop(*fit_collinear(df, cols, threshold, keep))


def target_corr_report(
    df: DataFrame, cols: Sequence[str], target: str, threshold: float, absolute: bool = False
) -> DataFrame:
    """``(column, corr, kept)``: kept when corr (or abs corr) > threshold."""
    tc = target_correlation(df, [c for c in cols if c != target], target)
    v = F.abs(F.col("corr")) if absolute else F.col("corr")
    return tc.withColumn("kept", F.coalesce(v > F.lit(float(threshold)), F.lit(False)))


def select_target_correlated(
    df: DataFrame, cols: Sequence[str], target: str, threshold: float, absolute: bool = False
) -> DataFrame:
    """Keep the columns correlated with the target above threshold, plus the target."""
    kept = {r["column"] for r in target_corr_report(df, cols, target, threshold, absolute).filter("kept").collect()}
    return df.select(*[_q(c) for c in cols if c in kept], _q(target))
