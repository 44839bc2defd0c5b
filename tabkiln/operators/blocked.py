"""Correlations of wide tables by blocks of columns.

The columns are cut into blocks; every pair of blocks is a tile.  A tile's
sums over pairwise complete rows come from one scan that reads its own columns
alone, added up batch by batch in the tasks with NumPy.  A task holds one tile
and one batch whatever the number of columns and rows.  The tasks' sums are
added by a grouped aggregate per column pair, so that the d x d matrix is a
distributed table and never lies in the driver or in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.operators.profile import CONSTANT_SHARE, _present, _q, profile_present_counts
from tabkiln.session import write_shared

# Columns in a block: a tile's six sums of TILE x TILE doubles take 12 MB a task.
TILE = 512
# Cells of a batch are turned into arrays this many rows at a time.
SLICE_ROWS = 4096
_SUMS = ["n", "sa", "sb", "qa", "qb", "p"]
_SCHEMA = "pos_a int, pos_b int, " + ", ".join(f"{s} double" for s in _SUMS)


def _add_tile(sums: dict, xa: np.ndarray, xb: np.ndarray) -> None:
    """Add the sums of some rows: NaN cells are missing, a pair counts where both are there."""
    ma, mb = ~np.isnan(xa), ~np.isnan(xb)
    if ma.all() and mb.all():
        sums["n"] += len(xa)
        sums["sa"] += xa.sum(axis=0)[:, None]
        sums["sb"] += xb.sum(axis=0)[None, :]
        sums["qa"] += (xa * xa).sum(axis=0)[:, None]
        sums["qb"] += (xb * xb).sum(axis=0)[None, :]
    else:
        xa, xb = np.where(ma, xa, 0.0), np.where(mb, xb, 0.0)
        ma, mb = ma.astype(float), mb.astype(float)
        sums["n"] += ma.T @ mb
        sums["sa"] += xa.T @ mb
        sums["sb"] += ma.T @ xb
        sums["qa"] += (xa * xa).T @ mb
        sums["qb"] += ma.T @ (xb * xb)
    sums["p"] += xa.T @ xb


def _tile_sums(left: list[int], right: list[int]):
    """The task of one tile; ``left`` and ``right`` are column positions, equal lists on the diagonal."""
    diagonal = left == right

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {s: np.zeros((len(left), len(right))) for s in _SUMS}
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns])
                _add_tile(sums, x[:, : len(left)], x if diagonal else x[:, len(left) :])
        for i, a in enumerate(left):  # one row of the tile to a batch; pairs a before b alone
            at = [j for j, b in enumerate(right) if a < b and sums["n"][i, j] > 0]
            if at:
                cells = [pa.array(sums[s][i, at]) for s in _SUMS]
                ids = [pa.array([a] * len(at), pa.int32()), pa.array([right[j] for j in at], pa.int32())]
                yield pa.RecordBatch.from_arrays(ids + cells, names=["pos_a", "pos_b", *_SUMS])

    return run


def correlation_sums(df: DataFrame, cols: Sequence[str], tile: int = TILE) -> DataFrame:
    """``(pos_a, pos_b, n, sa, sb, qa, qb, p)`` for every pair of columns that share a row.

    Count, sums, sums of squares and sum of products over the rows where both
    are there, of the values centred and scaled by each column's own mean and
    deviation.  The scans run on at most twice the session's parallelism of
    tasks each, which bounds the partial sums that are shuffled.
    """
    cols = list(cols)
    present = profile_present_counts(df, cols)

    def scaled(i: int) -> Column:
        mean, sd = present[cols[i]]["mean"], present[cols[i]]["sd"]
        x = _present(df, cols[i]).cast("double")
        finite = mean is not None and sd is not None and math.isfinite(mean) and math.isfinite(sd)
        return ((x - F.lit(mean)) * F.lit(1.0 / sd if sd else 1.0) if finite else x).alias(f"x{i}")

    ready = [scaled(i) for i in range(len(cols))]
    blocks = [list(range(s, min(s + tile, len(cols)))) for s in range(0, len(cols), tile)]
    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    out = None
    for bj, right in enumerate(blocks):
        for left in blocks[: bj + 1]:
            wanted = left if left == right else left + right
            part = df.select(*[ready[i] for i in wanted]).coalesce(tasks).mapInArrow(_tile_sums(left, right), _SCHEMA)
            out = part if out is None else out.unionByName(part)
    return out.groupBy("pos_a", "pos_b").agg(*[F.sum(s).alias(s) for s in _SUMS])


def blocked_pairs(df: DataFrame, cols: Sequence[str], tile: int = TILE) -> DataFrame:
    """``(col_a, col_b, pos_a, pos_b, corr)`` for every pair a before b (A5), kept distributed.

    Pearson over pairwise complete rows; NULL when a side is constant there
    (its variance below ``CONSTANT_SHARE`` of its mean square), when no row has
    both, or when a value is infinite.  Written to the shared checkpoint folder
    once, so that selections by different thresholds do not scan again.
    """
    cols = list(cols)
    if len(cols) < 2:
        raise ValueError("need at least two columns")
    if len(set(cols)) != len(cols):
        raise ValueError("a column is named twice")
    n = F.col("n")
    mean_a, mean_b, square_a, square_b = (F.col(s) / n for s in ("sa", "sb", "qa", "qb"))
    var_a, var_b = square_a - mean_a * mean_a, square_b - mean_b * mean_b
    known = (var_a > CONSTANT_SHARE * square_a) & (var_b > CONSTANT_SHARE * square_b)
    corr = F.when(known, (F.col("p") / n - mean_a * mean_b) / (F.sqrt(var_a) * F.sqrt(var_b)))
    # greatest and least pass over NULL (and NULL is not NaN), so a missing correlation must not reach them
    corr = F.when(corr.isNotNull() & ~F.isnan(corr), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), corr)))
    sums = correlation_sums(df, cols, tile).select("pos_a", "pos_b", corr.alias("corr"))

    spark = df.sparkSession
    # one row per column; every pair is there, also those without a common row
    names = spark.createDataFrame(list(enumerate(cols)), "pos int, col string")
    a, b = names.toDF("pos_a", "col_a"), names.toDF("pos_b", "col_b")
    pairs = b.withColumn("pos_a", F.explode(F.expr("sequence(0, greatest(pos_b - 1, 0))"))).filter("pos_a < pos_b")
    full = pairs.join(sums, ["pos_a", "pos_b"], "left").join(a, "pos_a")
    return write_shared(full.select("col_a", "col_b", "pos_a", "pos_b", "corr"), "correlations")


def collinear_columns(pairs: DataFrame, threshold: float = 0.95, keep: Sequence[str] = ()) -> list[str]:
    """Later columns of the pairs above ``threshold``, in column order.

    Reads the pairs above the threshold alone and collects one row per dropped column.
    """
    above = pairs.filter(F.abs("corr") > F.lit(float(threshold)))
    if keep:
        above = above.filter(~F.col("col_b").isin(list(keep)))
    return [r["col_b"] for r in above.select("pos_b", "col_b").distinct().orderBy("pos_b").collect()]


def remove_collinear(
    df: DataFrame, cols: Sequence[str], threshold: float = 0.95, keep: Sequence[str] = (), tile: int = TILE
) -> DataFrame:
    """``df`` without each column that correlates above ``threshold`` with an earlier one."""
    return df.drop(*collinear_columns(blocked_pairs(df, cols, tile), threshold, keep))
