"""Target statistics of categories (M2): ordered for training, whole for scoring.

In training a row's statistic comes only from rows of its category that lie
before it in a seeded order, so that no row sees its own label.  The order is
cut into ranges of (category, place), written once; a category that crosses
range borders is carried from range to range by a summary with one row per
range.  A category that holds a third of the rows is cut like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkiln.functions import fresh_name
from tabkiln.operators.ordered import _AT, _B, ROWS_PER_BUCKET, with_ranges
from tabkiln.operators.project import _missing
from tabkiln.operators.split import hash_order


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _label(df: DataFrame, target: str) -> Column:
    """The label as a double, NULL where missing."""
    return F.when(~_missing(df, target), _q(target).cast("double"))


def _smoothed(total: Column, n: Column, prior: float, weight: float) -> Column:
    """``(total + weight * prior) / (n + weight)``; the prior where both are nought."""
    total, n = F.coalesce(total, F.lit(0.0)), F.coalesce(n, F.lit(0))
    return F.coalesce(F.try_divide(total + F.lit(weight * prior), n + F.lit(weight)), F.lit(prior))


def target_prior(df: DataFrame, target: str) -> float:
    """Mean label of the labelled rows; 0 without any."""
    mean = df.agg(F.avg(_label(df, target))).first()[0]
    return 0.0 if mean is None else float(mean)


def ordered_target_stats(
    df: DataFrame,
    col: str,
    target: str,
    key: str,
    out: str | None = None,
    seed: int = 0,
    weight: float = 1.0,
    prior: float | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``df`` with ``<col>_stat``: smoothed mean label of the earlier rows of the same category.

    ``(sum of earlier labels + weight * prior) / (earlier labels + weight)``,
    earlier in the order of ``md5(seed:key)``, then key, then a hash of the row.
    ``prior`` is the mean label of the table unless given.  NULL is a category
    of its own.  A row without a label gets a statistic and adds nothing to
    others.  A key may repeat; rows equal in every column are interchangeable.
    """
    out = out or f"{col}_stat"
    if out in df.columns:
        raise ValueError(f"column {out} is there already")
    if weight < 0:
        raise ValueError("weight must not be negative")
    prior = target_prior(df, target) if prior is None else float(prior)
    place, label, in_n, in_sum, first = (fresh_name(df, n) for n in ("_place", "_label", "_in_n", "_in_sum", "_first"))
    staged = df.withColumn(place, hash_order(key, seed)).withColumn(label, _label(df, target))
    ranged, _ = with_ranges(staged, [col, place, key], rows_per_bucket)

    # per range its first and last category, and what the last one holds there
    summary = ranged.groupBy(_B, _q(col).alias("c")).agg(
        F.min(_AT).alias("at"), F.count(label).alias("n"), F.coalesce(F.sum(label), F.lit(0.0)).alias("s")
    )
    ends = summary.groupBy(_B).agg(
        F.min_by(F.struct("c"), "at").alias("first"), F.max_by(F.struct("c", "n", "s"), "at").alias("last")
    )
    along = Window.orderBy(_B)
    same = Window.partitionBy("last.c").orderBy(_B).rowsBetween(Window.unboundedPreceding, 0)
    running = ends.select(
        _B, "first", F.struct("last.c").alias("end"), F.sum("last.n").over(same).alias("n"), F.sum("last.s").over(same).alias("s")
    )
    goes_on = F.lag("end").over(along).eqNullSafe(F.col("first"))
    carries = running.select(
        _B,
        F.col("first.c").alias(first),
        F.when(goes_on, F.lag("n").over(along)).otherwise(0).alias(in_n),
        F.when(goes_on, F.lag("s").over(along)).otherwise(0.0).alias(in_sum),
    )
    # At most max_buckets rows: a proven bound for the broadcast.
    joined = ranged.join(F.broadcast(carries), _B)
    before = Window.partitionBy(_B, col).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    carried = _q(col).eqNullSafe(F.col(first))
    n = F.count(label).over(before) + F.when(carried, F.col(in_n)).otherwise(0)
    total = F.coalesce(F.sum(label).over(before), F.lit(0.0)) + F.when(carried, F.col(in_sum)).otherwise(0.0)
    return joined.withColumn(out, _smoothed(total, n, prior, weight)).select(*map(_q, df.columns), _q(out))


@dataclass(frozen=True)
class TargetStats:
    """Whole-table statistics of one column: a table ``(category, n, total)``, for rows that were not trained on."""

    table: DataFrame
    col: str
    prior: float
    weight: float

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """``df`` with ``<col>_stat``; a category not seen in training gets the prior.

        A plain join: AQE broadcasts the statistics if they are small and splits
        a category that holds much of ``df`` if they are not.
        """
        out = out or f"{self.col}_stat"
        if out in df.columns:
            raise ValueError(f"column {out} is there already")
        c, n, total = (fresh_name(df, x) for x in ("_category", "_n", "_total"))
        stats = self.table.toDF(c, n, total)
        joined = df.join(stats, _q(self.col).eqNullSafe(F.col(c)), "left")
        return joined.withColumn(out, _smoothed(F.col(total), F.col(n), self.prior, self.weight)).select(*map(_q, df.columns), _q(out))


def fit_target_stats(df: DataFrame, col: str, target: str, weight: float = 1.0, prior: float | None = None) -> TargetStats:
    """Statistics over all labelled rows of each category, partially summed before the shuffle."""
    prior = target_prior(df, target) if prior is None else float(prior)
    label = _label(df, target)
    table = df.groupBy(_q(col).alias("category")).agg(F.count(label).alias("n"), F.coalesce(F.sum(label), F.lit(0.0)).alias("total"))
    return TargetStats(table, col, prior, weight)


def encode_train_test(
    train: DataFrame, test: DataFrame, cols: Sequence[str], target: str, key: str, seed: int = 0, weight: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """Both tables with ``<col>_stat`` per column: ordered statistics for ``train``, whole ones for ``test``."""
    prior = target_prior(train, target)
    encoded = train
    for c in cols:
        encoded = ordered_target_stats(encoded, c, target, key, seed=seed, weight=weight, prior=prior)
        test = fit_target_stats(train, c, target, weight, prior).transform(test)
    return encoded, test
