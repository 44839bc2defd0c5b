"""Projections, filters and scalar transforms.

Each operator is one ``select``/``filter`` so that Catalyst collapses chains of
them into a single projection inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from tabkiln.functions.columns import is_bad_number


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Projection in the given order."""
    return df.select(*[_q(c) for c in cols])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns (P2); unknown names are ignored."""
    return df.drop(*cols)


# Keys of a value map up to which it is a chain of comparisons.
LITERAL_KEYS = 64


def map_values(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """Replace values by a mapping; values without a mapping become NULL.

    The mapping is a driver-side dict.  Up to ``LITERAL_KEYS`` keys are
    comparisons in the projection, more are a join with a local table (which
    Catalyst broadcasts where it is small): the same rows and the same type,
    the narrowest that holds all mapped values, either way.
    """
    out = out or col
    if not mapping:
        return df.withColumn(out, F.lit(None).cast(df.schema[col].dataType))
    schema = StructType([
        StructField("_map_key", _python_type(mapping.keys())),
        StructField("_map_value", _python_type(mapping.values())),
    ])
    cast = [str if isinstance(f.dataType, StringType) else float if isinstance(f.dataType, DoubleType) else None for f in schema]
    rows = [tuple(c(x) if c and x is not None else x for c, x in zip(cast, kv)) for kv in mapping.items()]
    if len(rows) <= LITERAL_KEYS:
        key_type, value_type = (f.dataType for f in schema)
        chosen = F.lit(None).cast(value_type)
        for k, v in reversed(rows):
            chosen = F.when(_q(col) == F.lit(k).cast(key_type), F.lit(v).cast(value_type)).otherwise(chosen)
        return df.withColumn(out, chosen)
    table = df.sparkSession.createDataFrame(rows, schema)
    joined = df.join(table, _q(col) == F.col("_map_key"), "left")
    return joined.withColumn(out, F.col("_map_value")).drop("_map_key", "_map_value")


def _python_type(values: Iterable) -> DataType:
    """Type of a list of Python scalars: bool, int, bigint, double, or string for anything else or a mixture."""
    present = [v for v in values if v is not None]
    if present and all(isinstance(v, bool) for v in present):
        return BooleanType()
    if present and all(isinstance(v, int) and not isinstance(v, bool) for v in present):
        return IntegerType() if all(-(2**31) <= v < 2**31 for v in present) else LongType()
    if present and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in present):
        return DoubleType()
    return StringType()


def _missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN in a floating column (what pandas calls missing)."""
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        return _q(c).isNull() | F.isnan(_q(c))
    return _q(c).isNull()


def fill_nulls(df: DataFrame, cols: Sequence[str], value) -> DataFrame:
    """Fill missing values (NULL, and NaN in floating columns) with a constant."""
    return df.select(
        *[
            F.when(_missing(df, c), F.lit(value).cast(df.schema[c].dataType)).otherwise(_q(c)).alias(c)
            if c in cols
            else _q(c)
            for c in df.columns
        ]
    )


def sum_columns(df: DataFrame, specs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``out = a + b`` for each ``(a, b, out)`` (P5)."""
    return df.withColumns({out: _q(a) + _q(b) for a, b, out in specs})


def diff_columns(df: DataFrame, specs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``out = a - b`` for each ``(a, b, out)`` (P6; the named intent)."""
    return df.withColumns({out: _q(a) - _q(b) for a, b, out in specs})


def log_transform(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Natural log; 0 stays 0, negatives become NULL."""
    return df.withColumns(
        {c: F.when(_q(c) == 0, F.lit(0.0)).when(_q(c) < 0, F.lit(None)).otherwise(F.ln(_q(c))) for c in cols}
    )


def apply_formula(df: DataFrame, formulas: Mapping[str, str | Callable[[Column], Column]]) -> DataFrame:
    """Per-value formula in ``x``; 0 where the value is 0, NULL stays NULL.

    A string formula is a SQL expression over the lambda variable ``x``, bound
    with a higher-order function, so nothing is evaluated in Python.
    """
    out = {}
    for c, f in formulas.items():
        if callable(f):
            value = f(_q(c))
        else:
            value = F.expr(f"transform(array(`{c}`), x -> ({f}))[0]")
        out[c] = F.when(_q(c) == 0, F.lit(0.0)).otherwise(value.cast("double"))
    return df.withColumns(out)


def downcast_types(df: DataFrame, int_fill_cols: Sequence[str] = ()) -> DataFrame:
    """Narrow numeric types.

    doubles become floats; longs become ints where all values of the column fit,
    read from one aggregate, and stay longs elsewhere; ``int_fill_cols`` get NULL
    -> 0 and int, or long where a value does not fit an int.  Strings stay strings; parquet dictionary-encodes low-cardinality text.
    """
    longs = [f.name for f in df.schema.fields if isinstance(f.dataType, LongType) and f.name not in int_fill_cols]
    filled = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name in int_fill_cols]
    wide: set[str] = set()
    if longs or filled:
        outside = [F.max(~_missing(df, c) & ~_q(c).between(-(2**31), 2**31 - 1)) for c in [*longs, *filled]]
        wide = {c for c, out in zip([*longs, *filled], df.agg(*outside).first()) if out}
    cols = []
    for f in df.schema.fields:
        c = _q(f.name)
        if f.name in int_fill_cols:
            cols.append(F.coalesce(c.try_cast("long" if f.name in wide else "int"), F.lit(0)).alias(f.name))
        elif isinstance(f.dataType, DoubleType):
            cols.append(c.cast("float").alias(f.name))
        elif f.name in longs and f.name not in wide:
            cols.append(c.cast("int").alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def sanitize_numbers(df: DataFrame, cols: Sequence[str] | None = None, value: float = 0.0) -> DataFrame:
    """NULL, NaN, +inf and -inf become ``value`` in floating columns (P10)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(is_bad_number(_q(c)), F.lit(value)).otherwise(_q(c)) for c in cols})


def normalize_names(df: DataFrame) -> DataFrame:
    """``lower().strip()`` of the column names."""
    return df.toDF(*[n.strip().lower() for n in df.columns])


def normalize_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``lower(trim(value))`` on string columns."""
    return df.withColumns({c: F.lower(F.trim(_q(c))) for c in cols})


def split_on_null(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Rows where ``col`` is set, rows where it is missing: NULL or NaN."""
    return df.filter(~_missing(df, col)), df.filter(_missing(df, col))


def complete_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows without any NULL (``dropna(how='any')``, P17)."""
    return df.dropna("any", subset=list(cols) if cols else None)


def non_null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row with the count of present values (not NULL, not NaN) of each column."""
    cols = list(cols) if cols else df.columns
    return df.agg(*[F.count(F.when(~_missing(df, c), 1)).alias(c) for c in cols])


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold only NULLs.

    Fit: one aggregate pass collected as a single row; transform: a projection.
    """
    counts = non_null_counts(df).first().asDict()
    keep = [c for c in df.columns if counts[c] > 0]
    return df.select(*[_q(c) for c in keep])


def tag(df: DataFrame, col: str, value) -> DataFrame:
    """Constant column, e.g. ``type='train'``."""
    return df.withColumn(col, F.lit(value))

