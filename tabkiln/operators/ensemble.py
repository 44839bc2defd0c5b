"""Collation of model predictions, ensembles and tolerance accuracy (M4-M6).

All prediction tables and the truth table are aligned on the key with a
single conditional aggregation over their union: one shuffle however many
models there are, with a map-side partial aggregate.  A key seen twice in one
input raises, as the reference's index alignment does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkiln.functions import abs_error, row_max, row_mean, row_median, row_min, tolerance_flag

ENSEMBLES = ("comb_max", "comb_min", "comb_mean", "comb_median")


def _pred_col(df: DataFrame, key: str) -> str:
    cols = [c for c in df.columns if c != key]
    if len(cols) != 1:
        raise ValueError(f"prediction table must have the key and one score column, got {df.columns}")
    return cols[0]


def align_predictions(
    preds: Sequence[DataFrame] | Mapping[str, DataFrame],
    key: str = "id",
    truth: DataFrame | None = None,
    target: str = "y",
) -> DataFrame:
    """Full outer alignment of n prediction tables on ``key``.

    With ``truth`` the result keeps only keys present in the truth table and in
    at least one prediction table (the inner merge of the reference, J2).
    """
    tables = list(preds.values()) if isinstance(preds, Mapping) else list(preds)
    names = [_pred_col(df, key) for df in tables]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate prediction column names: {names}")
    parts = [
        df.select(F.col(key), F.lit(i).alias("_src"), F.col(n).cast("double").alias("_v"))
        for i, (df, n) in enumerate(zip(tables, names))
    ]
    if truth is not None:
        parts.append(truth.select(F.col(key), F.lit(-1).alias("_src"), F.col(target).cast("double").alias("_v")))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)

    aggs = []
    for i, n in enumerate(names):
        aggs.append(F.max(F.when(F.col("_src") == i, F.col("_v"))).alias(n))
        aggs.append(F.count(F.when(F.col("_src") == i, 1)).alias(f"_n{i}"))
    if truth is not None:
        aggs.append(F.max(F.when(F.col("_src") == -1, F.col("_v"))).alias(target))
        aggs.append(F.count(F.when(F.col("_src") == -1, 1)).alias("_nt"))
    g = long.groupBy(key).agg(*aggs)

    counts = [f"_n{i}" for i in range(len(names))] + (["_nt"] if truth is not None else [])
    dup = F.greatest(*[F.col(c) for c in counts]) if len(counts) > 1 else F.col(counts[0])
    # The key is routed through the duplicate check so the optimizer cannot prune it.
    checked_key = F.when(
        dup > 1, F.raise_error(F.concat(F.lit("duplicate key "), F.col(key).cast("string")))
    ).otherwise(F.col(key))
    if truth is not None:
        present = sum((F.col(f"_n{i}") for i in range(len(names))), F.lit(0))
        g = g.filter((F.col("_nt") == 1) & (present > 0))
        rest = [target, *names]
    else:
        rest = list(names)
    return g.select(checked_key.alias(key), *rest)


def collate(
    preds: Sequence[DataFrame] | Mapping[str, DataFrame],
    truth: DataFrame,
    tolerance: float = 3.0,
    key: str = "id",
    target: str = "y",
) -> DataFrame:
    """Predictions with absolute errors, tolerance flags and ensembles (M4).

    Columns: key, target, then per model ``y_pred_<m>``, ``y_pred_<m>_abs_err``,
    ``result_<m>``; with more than one model the same for ``comb_max``,
    ``comb_min``, ``comb_mean`` and ``comb_median``.
    """
    return _with_ensembles(align_predictions(preds, key=key, truth=truth, target=target), tolerance, key, target)


def _one_per_key(df: DataFrame, key: str, col: str) -> DataFrame:
    """``(key, col)`` grouped by key, which raises for a key seen twice; no shuffle where ``df`` is bucketed by the key."""
    g = df.groupBy(key).agg(F.max(F.col(f"`{col}`").cast("double")).alias(col), F.count(F.lit(1)).alias("_seen"))
    raised = F.raise_error(F.concat(F.lit("duplicate key "), F.col(key).cast("string")))
    return g.filter(F.when(F.col("_seen") > 1, raised.cast("boolean")).otherwise(True)).drop("_seen")


def align_bucketed(
    preds: Sequence[DataFrame] | Mapping[str, DataFrame], truth: DataFrame, key: str = "id", target: str = "y"
) -> DataFrame:
    """:func:`align_predictions` with truth for tables bucketed alike by the key (``write_bucketed``).

    Left joins from the truth table keep its buckets, so that neither the
    duplicate check nor any of the joins moves a row, however many models there
    are.  Other tables give the same rows, with a shuffle each.  Keys that are
    NULL match nothing here.
    """
    tables = list(preds.values()) if isinstance(preds, Mapping) else list(preds)
    names = [_pred_col(df, key) for df in tables]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate prediction column names: {names}")
    marks = [f"_in{i}" for i in range(len(names))]
    out = _one_per_key(truth, key, target)
    for df, name, mark in zip(tables, names, marks):
        out = out.join(_one_per_key(df, key, name).withColumn(mark, F.lit(True)), key, "left")
    return out.filter(F.coalesce(*[F.col(m) for m in marks])).select(key, target, *names)


def collate_bucketed(
    preds: Sequence[DataFrame] | Mapping[str, DataFrame],
    truth: DataFrame,
    tolerance: float = 3.0,
    key: str = "id",
    target: str = "y",
) -> DataFrame:
    """:func:`collate` over tables bucketed alike by the key: repeated collation without a shuffle."""
    return _with_ensembles(align_bucketed(preds, truth, key, target), tolerance, key, target)


def _with_ensembles(aligned: DataFrame, tolerance: float, key: str, target: str) -> DataFrame:
    """Errors, flags and ensembles of aligned predictions."""
    pred_cols = [c for c in aligned.columns if c not in (key, target)]
    exprs = [F.col(key), F.col(target)]
    all_preds = [(c, F.col(c)) for c in pred_cols]
    if len(pred_cols) > 1:
        all_preds += [
            ("y_pred_comb_max", row_max(pred_cols)),
            ("y_pred_comb_min", row_min(pred_cols)),
            ("y_pred_comb_mean", row_mean(pred_cols)),
            ("y_pred_comb_median", row_median(pred_cols)),
        ]
    for name, c in all_preds:
        err = abs_error(c, target)
        model = name[len("y_pred_"):] if name.startswith("y_pred_") else name
        exprs += [c.alias(name), err.alias(f"{name}_abs_err"), tolerance_flag(err, tolerance).alias(f"result_{model}")]
    return aligned.select(*exprs)


def collate_pretrained(
    preds: Sequence[DataFrame] | Mapping[str, DataFrame],
    keys: DataFrame,
    key: str = "id",
) -> DataFrame:
    """Ensemble columns without truth (M5): key, predictions, comb_* columns."""
    marker = keys.select(F.col(key), F.lit(1.0).alias("_present"))
    aligned = align_predictions(preds, key=key, truth=marker, target="_present")
    pred_cols = [c for c in aligned.columns if c not in (key, "_present")]
    return aligned.select(
        F.col(key),
        *[F.col(c) for c in pred_cols],
        row_max(pred_cols).alias("y_pred_comb_max"),
        row_min(pred_cols).alias("y_pred_comb_min"),
        row_mean(pred_cols).alias("y_pred_comb_mean"),
        row_median(pred_cols).alias("y_pred_comb_median"),
    )


def result_columns(collated: DataFrame) -> list[str]:
    return [c for c in collated.columns if c.startswith("result_")]


def tolerance_accuracy(collated: DataFrame) -> DataFrame:
    """Share of correct rows per result column (A8): ``(result, accuracy)``.

    The reference reports 100.0 when a column holds only ones; this returns the
    fraction 1.0 there as everywhere else.
    """
    cols = result_columns(collated)
    wide = collated.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], cols, "result", "accuracy")


def result_value_counts(collated: DataFrame) -> DataFrame:
    """Counts of 0/1 per result column (A7): ``(result, value, n)``."""
    cols = result_columns(collated)
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("result"), F.lit(v).alias("value"), F.count(F.when(F.col(c) == v, 1)).alias("n"))
            for c in cols
            for v in (0, 1)
        ]
    )
    return (
        collated.agg(cells.alias("cells"))
        .select(F.explode("cells").alias("c"))
        .select("c.result", "c.value", "c.n")
        .filter(F.col("n") > 0)
    )


def collate_two(pred_a: DataFrame, pred_b: DataFrame, truth: DataFrame, tolerance: float = 3.0, key: str = "id", target: str = "y") -> DataFrame:
    """Two-model form kept for callers of the legacy entry point (M6).

    The legacy code ensembles result flags and misnames a column; this is the
    same as :func:`collate` with two tables.
    """
    return collate([pred_a, pred_b], truth, tolerance=tolerance, key=key, target=target)
