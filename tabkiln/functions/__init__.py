"""Column-level building blocks (all JVM-side expressions, no Python UDFs)."""

from tabkiln.functions.columns import (
    above,
    abs_error,
    bce_with_logits,
    binarize,
    fresh_name,
    is_bad_number,
    row_max,
    row_mean,
    row_median,
    row_min,
    safe_corr,
    sigmoid,
    tokens,
    tolerance_flag,
)

__all__ = [
    "above",
    "abs_error",
    "bce_with_logits",
    "binarize",
    "fresh_name",
    "is_bad_number",
    "row_max",
    "row_mean",
    "row_median",
    "row_min",
    "safe_corr",
    "sigmoid",
    "tokens",
    "tolerance_flag",
]
