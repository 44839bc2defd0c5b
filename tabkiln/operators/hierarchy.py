"""Hierarchical multi-label evaluation.

Scores are held long: one row per ``(id, level, kind, label_idx)`` with a
logit and a 0/1 truth, ``kind`` being ``main`` or ``sub``.  Every level and
kind is evaluated by the same aggregation keyed by ``(level, kind, ...)``
instead of a loop per level.  Per-label statistics are partial aggregates;
per-sample exact match groups by id, whose group size is the label count.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.functions import above, bce_with_logits, binarize, sigmoid
from tabkiln.operators.joins import attach_per_group
from tabkiln.operators.metrics import (
    LABEL_GRID,
    _best_point,
    _candidates,
    _ratio,
    _sweep,
    confusion_aggs,
    f1_expr,
    tune_thresholds,
)

GROUP = ["level", "kind"]
LABEL = ["level", "kind", "label_idx", "label_name"]


def with_probs(long: DataFrame, logit: str = "logit") -> DataFrame:
    return long.withColumn("prob", sigmoid(logit))


def label_thresholds(long: DataFrame, grid: Sequence[float] = LABEL_GRID) -> DataFrame:
    """Per-label F1 threshold (E2 with ``LABEL_GRID``, E3 with ``LABEL_GRID_FINE``).

    ``prob >= t``; a grid point counts only when truth and predictions both
    hold the two classes; labels without a candidate keep 0.5.
    """
    return tune_thresholds(
        with_probs(long), "prob", "y", LABEL, grid, inclusive=True, need_both_classes=True, default=0.5
    ).select(*LABEL, "threshold")


def _scored(long: DataFrame, thresholds: DataFrame | None, fixed: float = 0.5) -> DataFrame:
    s = with_probs(long).withColumn("pred_fixed", binarize("prob", fixed, inclusive=True))
    if thresholds is not None:
        s = attach_per_group(s, thresholds.select(*LABEL, F.col("threshold").alias("_thr")), LABEL, "left")
        s = s.withColumn("pred_opt", binarize("prob", F.coalesce(F.col("_thr"), F.lit(fixed)), inclusive=True))
    return s


def _averages(per_label: DataFrame, per_sample: DataFrame, keys: Sequence[str]) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    support = tp + fn
    lab = per_label.withColumns(
        {
            "_p": _ratio(tp, tp + fp),
            "_r": _ratio(tp, tp + fn),
            "_f": f1_expr(tp, fp, fn),
            "_s": support.cast("double"),
        }
    )
    g = lab.groupBy(*keys).agg(
        F.sum("tp").alias("tp"),
        F.sum("fp").alias("fp"),
        F.sum("fn").alias("fn"),
        F.avg("_p").alias("precision_macro"),
        F.avg("_r").alias("recall_macro"),
        F.avg("_f").alias("f1_macro"),
        F.sum(F.col("_p") * F.col("_s")).alias("_wp"),
        F.sum(F.col("_r") * F.col("_s")).alias("_wr"),
        F.sum(F.col("_f") * F.col("_s")).alias("_wf"),
        F.sum("_s").alias("_ws"),
    )
    out = g.select(
        *keys,
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision_micro"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall_micro"),
        f1_expr(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1_micro"),
        "precision_macro",
        "recall_macro",
        "f1_macro",
        _ratio(F.col("_wp"), F.col("_ws")).alias("precision_weighted"),
        _ratio(F.col("_wr"), F.col("_ws")).alias("recall_weighted"),
        _ratio(F.col("_wf"), F.col("_ws")).alias("f1_weighted"),
    )
    acc = per_sample.groupBy(*keys).agg(F.avg(F.col("_match").cast("double")).alias("accuracy"))
    return out.join(acc, list(keys))


def multilabel_metrics(long: DataFrame, thresholds: DataFrame | None = None, fixed: float = 0.5) -> DataFrame:
    """Micro / macro / weighted P, R, F1 and exact-match accuracy per (level, kind).

    One row per ``threshold_mode``: ``at_0.5`` and, with ``thresholds``,
    ``optimized``.  The mode is a grouping column (each scored row carries one
    prediction per mode), so one per-label and one per-sample aggregation
    serve every mode.
    """
    s = _scored(long, thresholds, fixed)
    modes = [("pred_fixed", f"at_{fixed}")] + ([("pred_opt", "optimized")] if thresholds is not None else [])
    per_mode = F.array(*[F.struct(F.lit(m).alias("threshold_mode"), F.col(c).alias("pred")) for c, m in modes])
    x = s.select(*GROUP, "label_idx", "id", "y", F.explode(per_mode).alias("_m")).select(
        *GROUP, "label_idx", "id", "y", "_m.threshold_mode", "_m.pred"
    )
    keys = [*GROUP, "threshold_mode"]
    per_label = x.groupBy(*keys, "label_idx").agg(*confusion_aggs("pred", "y"))
    per_sample = x.groupBy(*keys, "id").agg(F.min((F.col("pred") == F.col("y")).cast("int")).alias("_match"))
    return _averages(per_label, per_sample, keys)


def evaluate(long: DataFrame, grid: Sequence[float] = LABEL_GRID) -> DataFrame:
    """Metrics at 0.5 and at tuned per-label thresholds for every level and kind."""
    return multilabel_metrics(long, label_thresholds(long, grid))


def per_class_report(long: DataFrame, grid: Sequence[float] = LABEL_GRID, default: float = 0.5) -> DataFrame:
    """Per label: tuned threshold, P/R/F1 and counts at it (E5).

    One aggregation: the counts at the tuned threshold are the chosen sweep
    point, and counts at the default threshold (used when no grid point
    qualifies) are summed alongside the histogram.  Counts are forced to 0
    when the truth of the label holds a single class.
    """
    y = F.col("y")
    at_default = above("prob", default, inclusive=True)
    extra = {
        "d_tp": F.coalesce(at_default & (y == 1), F.lit(False)),
        "d_fp": F.coalesce(at_default & (y == 0), F.lit(False)),
        "d_tn": F.coalesce(~at_default & (y == 0), y == 0),
        "d_fn": F.coalesce(~at_default & (y == 1), y == 1),
    }
    s = _sweep(with_probs(long), "prob", "y", LABEL, grid, True, extra=extra)
    b = s.select(*LABEL, "P", "N", *extra, _best_point(_candidates(True)).alias("b"))
    single = (F.col("P") == 0) | (F.col("P") == F.col("N"))
    zero = F.lit(0).cast("long")
    counts = {
        k: F.when(single, zero).otherwise(F.coalesce(F.col(f"b.{k}"), F.col(f"d_{k}")).cast("long"))
        for k in ("tp", "fp", "tn", "fn")
    }
    c = b.select(
        *LABEL,
        F.coalesce(F.col("b.threshold"), F.lit(float(default))).alias("optimal_threshold"),
        *[v.alias(k) for k, v in counts.items()],
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        *LABEL,
        "optimal_threshold",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        f1_expr(tp, fp, fn).alias("f1_score"),
        "tp",
        "tn",
        "fp",
        "fn",
    )


def default_loss_weights(levels: Sequence[int]) -> dict:
    """Level weight ``1 + 0.1 * (level - 1)``, sub-labels at 0.8 of their level."""
    w = {}
    for level in levels:
        lw = 1.0 + (level - 1) * 0.1
        w[(level, "main")] = lw
        w[(level, "sub")] = lw * 0.8
    return w


def hierarchical_bce(
    long: DataFrame,
    weights: Mapping | None = None,
    loss: Callable[[str, str], Column] = bce_with_logits,
) -> DataFrame:
    """Mean loss per (level, kind), its weight and weighted value.

    ``loss`` builds the loss of one element from the logit and label columns;
    BCE with logits unless told otherwise.

    The mean runs over all elements of a level and kind (the reference
    averages per batch, which depends on the batch size).  Without ``weights``
    every level gets its default weight (see ``default_loss_weights``); with
    them, a level and kind they do not name gets 1.
    """
    g = long.groupBy(*GROUP).agg(F.avg(loss("logit", "y")).alias("loss"))
    if weights:
        wmap = F.create_map(*[x for (lvl, kind), v in weights.items() for x in (F.lit(f"{lvl}|{kind}"), F.lit(float(v)))])
        w = F.coalesce(F.try_element_at(wmap, F.concat_ws("|", F.col("level").cast("string"), F.col("kind"))), F.lit(1.0))
    else:
        w = (1.0 + (F.col("level") - 1) * 0.1) * F.when(F.col("kind") == "sub", 0.8).otherwise(1.0)
    return g.select(*GROUP, "loss", w.alias("weight"), (F.col("loss") * w).alias("weighted_loss"))


def total_loss(losses: DataFrame) -> DataFrame:
    return losses.agg(F.sum("weighted_loss").alias("total_loss"))


def wide_predictions(
    df: DataFrame,
    key: str,
    levels: Mapping[int, tuple[str, str]],
    n_main: int,
    n_sub: int,
    threshold: float = 0.5,
) -> DataFrame:
    """Static wide table of probabilities and 0/1 predictions (M7).

    ``levels`` maps a level to its (main logits, sub logits) array columns;
    sub logits are flat ``n_main * n_sub`` arrays.  One projection, no shuffle.
    """
    cols: list[Column] = [F.col(key)]
    for level, (main, sub) in sorted(levels.items()):
        for i in range(n_main):
            p = sigmoid(F.col(main)[i])
            cols.append(p.alias(f"main_prob_level{level}_label{i}"))
            cols.append(binarize(p, threshold, inclusive=True).alias(f"main_pred_level{level}_label{i}"))
        for i in range(n_main):
            for j in range(n_sub):
                p = sigmoid(F.col(sub)[i * n_sub + j])
                cols.append(p.alias(f"sub_prob_level{level}_main{i}_sub{j}"))
                cols.append(binarize(p, threshold, inclusive=True).alias(f"sub_pred_level{level}_main{i}_sub{j}"))
    return df.select(*cols)


def nested_pairs(df: DataFrame, key: str, info: str, codes: str, scores: str) -> DataFrame:
    """Parallel arrays of a struct column to ``(key, pos, code, score)`` rows."""
    z = F.arrays_zip(F.col(f"{info}.{codes}").alias("code"), F.col(f"{info}.{scores}").alias("score"))
    return df.select(key, F.posexplode(z).alias("pos", "p")).select(
        key, "pos", F.col("p.code").cast("double").alias("code"), F.col("p.score").cast("double").alias("score")
    )


def sublabel_violations(df: DataFrame, key: str, main: str, sub: str) -> DataFrame:
    """Sub labels set where their main label is 0 (E10): ``(key, main_idx, sub_idx)``."""
    m = df.select(key, F.posexplode(F.col(main)).alias("main_idx", "main_y"), F.col(sub).alias("_sub"))
    m = m.filter(F.col("main_y") == 0).select(key, "main_idx", F.col("_sub")[F.col("main_idx")].alias("_row"))
    s = m.select(key, "main_idx", F.posexplode("_row").alias("sub_idx", "sub_y"))
    return s.filter(F.col("sub_y") != 0).select(key, "main_idx", "sub_idx")
