"""Classification and regression metrics, threshold tuning.

Confusion counts are conditional sums in one aggregation (partial aggregate
map-side, so a category holding a third of all rows is reduced before the
shuffle).  Threshold tuning does not rescan the data per grid point: every
row falls into one bucket of the grid, a histogram per (group, bucket) is
aggregated, and the sweep over the grid runs on arrays of ``len(grid) + 1``
counts per group with higher-order functions.  All metrics are
order-free aggregates, so no sort by id precedes them (T4).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.functions import above, binarize
from tabkiln.operators.joins import attach_per_group


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Threshold grids, built by the same rules as the numpy calls they stand for.
def linspace_grid(start: float, stop: float, num: int) -> list[float]:
    return [float(x) for x in np.linspace(start, stop, num)]


def arange_grid(start: float, stop: float, step: float) -> list[float]:
    return [float(x) for x in np.arange(start, stop, step)]


CATEGORY_GRID = linspace_grid(0.01, 0.99, 99)
LABEL_GRID = arange_grid(0.1, 1.0, 0.1)
LABEL_GRID_FINE = arange_grid(0.05, 0.95, 0.05)


# --------------------------------------------------------------------------
# confusion counts and derived metrics
# --------------------------------------------------------------------------

def confusion_aggs(pred: str | Column, label: str | Column) -> list[Column]:
    p, y = _c(pred), _c(label)
    return [
        F.sum(F.when((p == 1) & (y == 1), 1).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when((p == 1) & (y == 0), 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when((p == 0) & (y == 0), 1).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when((p == 0) & (y == 1), 1).otherwise(0)).cast("long").alias("fn"),
    ]


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def precision_expr(tp: Column, fp: Column) -> Column:
    return _ratio(tp, tp + fp)


def recall_expr(tp: Column, fn: Column) -> Column:
    return _ratio(tp, tp + fn)


def f1_expr(tp: Column, fp: Column, fn: Column) -> Column:
    """F1 as ``2tp / (2tp + fp + fn)``: equal counts ratios give bit-equal values, so ties are exact."""
    return _ratio(2 * tp, 2 * tp + fp + fn)


def with_rates(counts: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.withColumns(
        {
            "accuracy": _ratio(tp + tn, tp + fp + tn + fn),
            "precision": precision_expr(tp, fp),
            "recall": recall_expr(tp, fn),
            "f1": f1_expr(tp, fp, fn),
        }
    )


def binary_metrics(
    df: DataFrame,
    prob: str,
    label: str,
    threshold: float | str | Column = 0.5,
    by: Sequence[str] = (),
    inclusive: bool = False,
) -> DataFrame:
    """tp/fp/tn/fn, accuracy, precision, recall and F1 at a threshold.

    ``threshold`` may be a column name holding a per-row threshold (J6).  Rows
    without a label are left out.
    """
    df = df.filter(F.col(label).isNotNull())
    t = F.col(threshold) if isinstance(threshold, str) else threshold
    pred = binarize(prob, t, inclusive)
    counts = df.groupBy(*by).agg(*confusion_aggs(pred, label), F.count(F.lit(1)).alias("num_samples"))
    return with_rates(counts)


def regression_metrics(
    df: DataFrame, pred: str, label: str, by: Sequence[str] = (), with_total: str | None = None
) -> DataFrame:
    """``n``, RMSE and R^2 (A10, A11); R^2 is NULL for a constant target.

    With ``with_total`` the groups are rolled up in the same pass and the total
    row carries that label in the (single) ``by`` column.
    """
    err2 = F.pow(F.col(pred) - F.col(label), 2)
    grouped = df.rollup(*by) if with_total is not None else df.groupBy(*by)
    out = grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(err2)).alias("rmse"),
        F.sum(err2).alias("_sse"),
        F.var_pop(F.col(label)).alias("_var"),
    )
    r2 = F.lit(1.0) - F.try_divide(F.col("_sse"), F.nullif(F.col("n") * F.col("_var"), F.lit(0.0)))
    out = out.withColumn("r2", r2).drop("_sse", "_var")
    if with_total is not None:
        out = out.withColumn(by[0], F.coalesce(F.col(by[0]).cast("string"), F.lit(with_total)))
    return out


# --------------------------------------------------------------------------
# threshold sweep and tuning
# --------------------------------------------------------------------------

def _uniform_step(grid: Sequence[float]) -> float | None:
    if len(grid) < 2:
        return None
    step = (grid[-1] - grid[0]) / (len(grid) - 1)
    if step <= 0 or any(abs((grid[i] - grid[0]) - i * step) > 1e-9 * max(1.0, abs(step)) for i in range(len(grid))):
        return None
    return step


def grid_bucket(prob: str | Column, grid: Sequence[float], inclusive: bool) -> Column:
    """Number of grid points the probability clears (``p > g``, or ``p >= g``).

    Positive at grid index t iff bucket > t.  For an evenly spaced grid the
    arithmetic estimate ``e`` is off by at most one, so the bucket is the
    points surely cleared below it plus exact checks of the three points
    around it: a flat expression without per-row lambdas.  Other grids count
    with a filter.  NULL / NaN probabilities clear no grid point.
    """
    p = _c(prob)
    n = len(grid)
    g = F.array(*[F.lit(float(x)) for x in grid])
    step = _uniform_step(grid)
    if step is None:
        return F.size(F.filter(g, lambda x: p >= x if inclusive else p > x))
    est_d = F.floor((p - F.lit(float(grid[0]))) / F.lit(step)) + 1
    est = F.least(F.greatest(est_d, F.lit(-2.0)), F.lit(float(n + 2))).cast("int")
    base = F.least(F.greatest(est - 2, F.lit(0)), F.lit(n))
    total = base
    for off in (-1, 0, 1):
        i = est + off  # 1-based grid position
        x = F.element_at(g, F.least(F.greatest(i, F.lit(1)), F.lit(n)))
        hit = (i >= 1) & (i <= n) & (p >= x if inclusive else p > x)
        total = total + F.when(hit, 1).otherwise(0)
    bad = p.isNull() | F.isnan(p)
    return F.when(bad, F.lit(0)).otherwise(total)


def _sweep(
    df: DataFrame,
    prob: str,
    label: str,
    by: Sequence[str],
    grid: Sequence[float],
    inclusive: bool,
    extra: dict | None = None,
) -> DataFrame:
    """One row per group with ``sweep``: array of structs (t, threshold, tp, fp, fn, tn, f1).

    ``extra`` maps names to 0/1 columns summed per group in the same pass.
    Rows without a label are left out.
    """
    df = df.filter(F.col(label).isNotNull())
    n_grid = len(grid)
    extra = dict(extra or {})
    bucket = grid_bucket(prob, grid, inclusive)
    hist = df.groupBy(*by, bucket.alias("_b")).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"),
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c.cast("long")).alias(name) for name, c in extra.items()],
    )
    per_group = hist.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("_b", F.struct("_pos", "_n")))).alias("_h"),
        F.sum("_pos").alias("P"),
        F.sum("_n").alias("N"),
        *[F.sum(name).alias(name) for name in extra],
    )
    dense_pos = F.transform(F.sequence(F.lit(0), F.lit(n_grid)), lambda b: F.coalesce(F.col("_h")[b]["_pos"], F.lit(0).cast("long")))
    dense_n = F.transform(F.sequence(F.lit(0), F.lit(n_grid)), lambda b: F.coalesce(F.col("_h")[b]["_n"], F.lit(0).cast("long")))
    staged = per_group.select(*by, "P", "N", *extra, dense_pos.alias("_pos"), dense_n.alias("_cnt"))
    grid_arr = F.array(*[F.lit(float(x)) for x in grid])

    def point(t: Column) -> Column:
        # buckets t+1 .. n_grid are predicted positive at grid index t
        tp = F.aggregate(F.slice(F.col("_pos"), t + 2, F.lit(n_grid) - t), F.lit(0).cast("long"), lambda a, x: a + x)
        pp = F.aggregate(F.slice(F.col("_cnt"), t + 2, F.lit(n_grid) - t), F.lit(0).cast("long"), lambda a, x: a + x)
        fp = pp - tp
        fn = F.col("P") - tp
        tn = F.col("N") - F.col("P") - fp
        return F.struct(
            t.alias("t"),
            F.element_at(grid_arr, t + 1).alias("threshold"),
            tp.alias("tp"),
            fp.alias("fp"),
            fn.alias("fn"),
            tn.alias("tn"),
            f1_expr(tp, fp, fn).alias("f1"),
        )

    return staged.select(
        *by, "P", "N", *extra, F.transform(F.sequence(F.lit(0), F.lit(n_grid - 1)), point).alias("sweep")
    )


def threshold_sweep(
    df: DataFrame, prob: str, label: str, by: Sequence[str], grid: Sequence[float], inclusive: bool = False
) -> DataFrame:
    """Counts and F1 at every grid threshold per group (W6): ``(by, threshold, tp, fp, fn, tn, f1)``."""
    s = _sweep(df, prob, label, by, grid, inclusive)
    return s.select(*by, F.explode("sweep").alias("s")).select(*by, "s.threshold", "s.tp", "s.fp", "s.fn", "s.tn", "s.f1")


def _best_point(cands: Column) -> Column:
    """Grid point with the highest F1, ties to the smallest threshold (T5); NULL if none."""
    return F.array_max(F.transform(cands, lambda x: F.struct(x["f1"].alias("f1"), (-x["t"]).alias("neg_t"), x.alias("p"))))["p"]


def _candidates(need_both_classes: bool) -> Column:
    cands = F.col("sweep")
    if need_both_classes:
        both_truth = (F.col("P") > 0) & (F.col("P") < F.col("N"))
        cands = F.filter(
            cands,
            lambda x: both_truth & ((x["tp"] + x["fp"]) > 0) & ((x["tn"] + x["fn"]) > 0) & (x["f1"] > 0),
        )
    return cands


def tune_thresholds(
    df: DataFrame,
    prob: str,
    label: str,
    by: Sequence[str],
    grid: Sequence[float] = CATEGORY_GRID,
    inclusive: bool = False,
    need_both_classes: bool = False,
    default: float = 0.5,
) -> DataFrame:
    """Best F1 threshold per group (E1, E2, E3, T5): ``(by, threshold, f1)``.

    Ties go to the smallest threshold.  With ``need_both_classes`` (the
    per-label variant) a grid point is a candidate only when the truth and the
    predictions both hold the two classes, its F1 must be above 0, and groups
    without a candidate keep ``default``.  Without it every grid point is a
    candidate (best F1 starts below 0) so an all-zero group picks the first.
    """
    s = _sweep(df, prob, label, by, grid, inclusive)
    out = s.select(*by, _best_point(_candidates(need_both_classes)).alias("_best"))
    return out.select(
        *by,
        F.coalesce(F.col("_best.threshold"), F.lit(float(default))).alias("threshold"),
        F.col("_best.f1").alias("f1"),
    )


def apply_thresholds(
    df: DataFrame,
    thresholds: DataFrame,
    prob: str,
    by: Sequence[str],
    inclusive: bool = False,
    out: str = "pred",
    keep_threshold: bool = False,
) -> DataFrame:
    """Binarize each row with its group's tuned threshold.

    The threshold table has one row per group; the join is lazy and its
    strategy is AQE's.  ``keep_threshold`` keeps it as ``_thr``.
    """
    j = attach_per_group(df, thresholds.select(*by, F.col("threshold").alias("_thr")), by, "left")
    j = j.withColumn(out, binarize(prob, F.col("_thr"), inclusive))
    return j if keep_threshold else j.drop("_thr")


def category_report(
    df: DataFrame,
    prob: str,
    label: str,
    category: str,
    grid: Sequence[float] = CATEGORY_GRID,
) -> DataFrame:
    """Per category: samples, tuned threshold and metrics at it.

    The counts at the tuned threshold are read from the sweep itself, so the
    data is aggregated once and never joined back.
    """
    s = _sweep(df, prob, label, [category], grid, False)
    best = s.select(category, F.col("N").alias("num_samples"), _best_point(F.col("sweep")).alias("b"))
    m = with_rates(best.select(category, "num_samples", *[F.col(f"b.{k}").alias(k) for k in ("tp", "fp", "tn", "fn")], F.col("b.threshold").alias("optimal_threshold")))
    return m.select(
        category,
        "num_samples",
        "optimal_threshold",
        F.col("f1").alias("f1_optimized"),
        F.col("accuracy").alias("accuracy_optimized"),
        F.col("precision").alias("precision_optimized"),
        F.col("recall").alias("recall_optimized"),
    ).orderBy(category)


def overall_metrics(
    df: DataFrame,
    prob: str,
    label: str,
    category: str,
    grid: Sequence[float] = CATEGORY_GRID,
    fixed: float = 0.5,
) -> DataFrame:
    """Overall metrics at the fixed threshold and with per-category tuned thresholds.

    ``(threshold_mode, tp, fp, tn, fn, accuracy, precision, recall, f1)``.  One
    aggregation of the data: the fixed-threshold counts ride along with the
    histogram, the tuned counts are the best sweep points summed over categories.
    """
    y = F.col(label)
    pred = above(prob, fixed)
    extra = {
        "f_tp": pred & (y == 1),
        "f_fp": pred & (y == 0),
        "f_tn": ~pred & (y == 0),
        "f_fn": ~pred & (y == 1),
    }
    # a NULL probability is predicted negative, as at the tuned thresholds
    extra = {k: F.coalesce(v, (y == 1) if k == "f_fn" else (y == 0) if k == "f_tn" else F.lit(False)) for k, v in extra.items()}
    s = _sweep(df, prob, label, [category], grid, False, extra=extra)
    best = s.select(*extra, _best_point(F.col("sweep")).alias("b"))
    agg = best.agg(
        *[F.sum(k).alias(k) for k in extra],
        *[F.sum(f"b.{k}").alias(f"o_{k}") for k in ("tp", "fp", "tn", "fn")],
    )
    cells = F.array(
        *[
            F.struct(F.lit(mode).alias("threshold_mode"), *[F.col(f"{pfx}_{n}").cast("long").alias(n) for n in ("tp", "fp", "tn", "fn")])
            for mode, pfx in ((f"at_{fixed}", "f"), ("optimized", "o"))
        ]
    )
    return with_rates(agg.select(F.explode(cells).alias("s")).select("s.*"))


def metrics_long(overall: DataFrame, prefix: str = "overall") -> DataFrame:
    """Flat ``(name, value)`` rows named ``<prefix>_<metric>_<mode>``."""
    metrics = ["accuracy", "f1", "precision", "recall", "tp", "fp", "tn", "fn"]
    cells = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    )
    x = overall.select("threshold_mode", F.explode(cells).alias("s"))
    return x.select(
        F.concat_ws("_", F.lit(prefix), F.col("s.metric"), F.col("threshold_mode")).alias("name"),
        F.col("s.value").alias("value"),
    )
