"""Scaling and derived numeric features.

Fit = one aggregate pass (min/max/mean for all columns together) collected as
one small row; transform = a projection with the statistics as literals, so
the transformed table needs no join and no second pass.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.operators.profile import fit_stats


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class MinMaxModel:
    """Per-column ``(min, max)`` and target range ``(lo, hi)``."""

    stats: dict
    ranges: dict

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (mn, mx) in self.stats.items():
            lo, hi = self.ranges[c]
            if mn is None:
                continue
            span = mx - mn
            if span == 0:
                # scikit-learn maps a constant column to the range minimum
                out[c] = F.when(_q(c).isNotNull(), F.lit(float(lo)))
            else:
                out[c] = (_q(c).cast("double") - F.lit(float(mn))) / F.lit(float(span)) * F.lit(float(hi - lo)) + F.lit(
                    float(lo)
                )
        return df.withColumns(out)


def fit_minmax(df: DataFrame, cols: Sequence[str], feature_range: tuple[float, float] = (0.0, 1.0)) -> MinMaxModel:
    """Min-max scaling of ``cols`` to ``feature_range`` (F1, F2)."""
    st = fit_stats(df, cols)
    return MinMaxModel({c: (st[c]["min"], st[c]["max"]) for c in cols}, {c: tuple(feature_range) for c in cols})


def stratified_range(mean: float | None) -> tuple[float, float]:
    """Target range chosen by the column mean."""
    # fixed values: mean above 1000 -> (0, 10), above 100 -> (0, 5), above 10 -> (0, 2), else (0, 1)
    if mean is None:
        return (0.0, 1.0)
    if mean > 1000:
        return (0.0, 10.0)
    if mean > 100:
        return (0.0, 5.0)
    if mean > 10:
        return (0.0, 2.0)
    return (0.0, 1.0)


def fit_minmax_stratified(df: DataFrame, cols: Sequence[str]) -> MinMaxModel:
    """Min-max scaling with a range picked from each column's mean."""
    st = fit_stats(df, cols)
    return MinMaxModel(
        {c: (st[c]["min"], st[c]["max"]) for c in cols}, {c: stratified_range(st[c]["mean"]) for c in cols}
    )


def replace_positive_inf(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """+inf -> value, as the stratified scaler does before fitting."""
    return df.withColumns({c: F.when(_q(c) == F.lit(float("inf")), F.lit(value)).otherwise(_q(c)) for c in cols})


@dataclass(frozen=True)
class CenterModel:
    stats: dict
    as_float: bool = True

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, s in self.stats.items():
            for kind in ("mean", "max", "min"):
                v = _q(c).cast("double") - F.lit(s[kind])
                out[f"{c}_minus_{kind}"] = v.cast("float") if self.as_float else v
        return df.withColumns(out)


def fit_center(df: DataFrame, cols: Sequence[str], as_float: bool = True) -> CenterModel:
    """``<c>_minus_mean``, ``<c>_minus_max``, ``<c>_minus_min`` columns."""
    st = fit_stats(df, cols)
    return CenterModel({c: st[c] for c in cols}, as_float)


def pair_features(df: DataFrame, cols: Sequence[str], as_float: bool = True, max_cols: int = 64) -> DataFrame:
    """For every ordered pair (a, b), a != b: ``a_diff_b``, ``a_sum_b``, ``a_ratio_b``.

    3 * n * (n - 1) new columns in one projection; ``max_cols`` guards against
    a quadratic blow-up of the schema.  Division by zero gives NULL.
    """
    cols = list(cols)
    if len(cols) > max_cols:
        raise ValueError(f"{len(cols)} columns give {3 * len(cols) * (len(cols) - 1)} pair features; raise max_cols")
    out = {}
    for a, b in itertools.permutations(cols, 2):
        x, y = _q(a).cast("double"), _q(b).cast("double")
        feats = {"diff": x - y, "sum": x + y, "ratio": F.try_divide(x, y)}
        for name, v in feats.items():
            out[f"{a}_{name}_{b}"] = v.cast("float") if as_float else v
    return df.withColumns(out)
