"""Scalar and row-wise column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
that it stays inside whole-stage codegen.  ANSI mode is on in Spark 4: these
helpers avoid the expressions that raise (division by zero, NaN casts).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid(c: ColumnOrName) -> Column:
    return 1.0 / (1.0 + F.exp(-_c(c)))


def above(x: ColumnOrName, threshold: float | Column, inclusive: bool = False) -> Column:
    """``x > threshold`` (or ``>=``) with NaN never above anything.

    Spark orders NaN above every number, Python and NumPy compare it as false;
    the NumPy reading is the one kept.  NULL stays NULL.
    """
    v = _c(x)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    cond = v >= t if inclusive else v > t
    return cond & ~F.isnan(v)


def binarize(prob: ColumnOrName, threshold: float | Column, inclusive: bool = False) -> Column:
    """1 when ``prob > threshold`` (or ``>=`` when inclusive), else 0 (NULL and NaN give 0)."""
    return F.when(above(prob, threshold, inclusive), 1).otherwise(0)


def abs_error(pred: ColumnOrName, truth: ColumnOrName) -> Column:
    return F.abs(_c(pred) - _c(truth))


def tolerance_flag(err: ColumnOrName, tolerance: float) -> Column:
    """0 when the error exceeds the tolerance, else 1.

    An error equal to the tolerance counts as correct, and a NULL or NaN error
    falls to 1, as ``0 if x > th else 1`` does for NaN.
    """
    return F.when(above(err, tolerance), 0).otherwise(1)


def _num(c: ColumnOrName) -> Column:
    """Double with NaN read as missing, as pandas row-wise statistics skip it."""
    x = _c(c).cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def row_max(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise maximum skipping NULL and NaN (NULL when none is left)."""
    if len(cols) == 1:
        return _num(cols[0])
    return F.greatest(*[_num(c) for c in cols])


def row_min(cols: Sequence[ColumnOrName]) -> Column:
    if len(cols) == 1:
        return _num(cols[0])
    return F.least(*[_num(c) for c in cols])


def row_mean(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise mean over the values present (NULL when none is)."""
    total = sum((F.coalesce(_num(c), F.lit(0.0)) for c in cols), F.lit(0.0))
    count = sum((_num(c).isNotNull().cast("double") for c in cols), F.lit(0.0))
    return F.try_divide(total, F.nullif(count, F.lit(0.0)))


def row_median(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise median over the values present.

    ``sort_array`` puts NULLs first, so the present values occupy the last
    ``n`` slots and the middle ones are found by index arithmetic (no lambda,
    so the expression stays in generated code).
    """
    k = len(cols)
    if k == 1:
        return _num(cols[0])
    arr = F.sort_array(F.array(*[_num(c) for c in cols]))
    n = sum((_num(c).isNotNull().cast("int") for c in cols), F.lit(0))
    first = F.lit(k) - n  # 0-based position of the first present value
    lo = F.try_element_at(arr, (first + F.floor((n - 1) / 2) + 1).cast("int"))
    hi = F.try_element_at(arr, (first + F.floor(n / 2) + 1).cast("int"))
    return F.when(n == 0, F.lit(None).cast("double")).otherwise((lo + hi) / 2.0)


def is_bad_number(c: ColumnOrName) -> Column:
    """NULL, NaN, +inf or -inf."""
    x = _c(c)
    return x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf"))


def safe_corr(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Pearson correlation over pairwise complete rows (NaN read as missing); NULL for a constant side.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI for a constant column and a
    ``when`` around the aggregate does not help, so the ratio is built from
    population covariance and standard deviations with ``try_divide``.  The
    deviation of a constant is not always 0 once partitions are merged, so a
    side is constant where its least and greatest value are equal.
    """
    x, y = _num(a), _num(b)
    both = x.isNotNull() & y.isNotNull()
    x_both, y_both = F.when(both, x), F.when(both, y)
    varies = (F.min(x_both) < F.max(x_both)) & (F.min(y_both) < F.max(y_both))
    spread = F.stddev_pop(x_both) * F.stddev_pop(y_both)
    return F.when(varies, F.try_divide(F.covar_pop(x, y), F.nullif(spread, F.lit(0.0))))


def tokens(text: ColumnOrName) -> Column:
    """Whitespace tokens of a text, empty strings removed."""
    return F.array_remove(F.split(_c(text), r"[ \t\n\r]+"), "")


def bce_with_logits(logit: ColumnOrName, label: ColumnOrName) -> Column:
    """Numerically stable binary cross entropy on a logit."""
    x, y = _c(logit).cast("double"), _c(label).cast("double")
    return F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
