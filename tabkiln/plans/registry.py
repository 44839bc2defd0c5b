"""Registry of named queries and their DuckDB oracle SQL.

A query is a function ``(spark, sf_dir) -> DataFrame``.  Double columns that
are compared against the oracle are rounded to ``DIGITS`` decimals on both
sides, since sums and averages may differ in the last bits by evaluation order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS = 6

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    doubles: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Entry] = {}


def _rounded(c: str, digits: int):
    # a value rounding to zero is returned as +0.0 on both sides (DuckDB keeps -0.0)
    r = F.round(F.col(c), digits)
    return F.when(r == 0, F.lit(0.0)).otherwise(r).alias(c)


def round_doubles(df: DataFrame, cols: Sequence[str], digits: int = DIGITS) -> DataFrame:
    wanted = set(cols)
    return df.select(*[_rounded(c, digits) if c in wanted else F.col(c) for c in df.columns])


def oracle_wrap(sql: str, cols: Sequence[str], digits: int = DIGITS) -> str:
    if not cols:
        return sql
    repl = ", ".join(
        f"CASE WHEN round({c}, {digits}) = 0 THEN 0.0::DOUBLE ELSE round({c}, {digits}) END AS {c}" for c in cols
    )
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"


def register(name: str, sql: str | None = None, doubles: Sequence[str] = ()) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        cols = tuple(doubles)

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir), cols)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Entry(name, run, None if sql is None else oracle_wrap(sql, cols), cols)
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: e.fn for k, e in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: e.sql for k, e in REGISTRY.items() if e.sql is not None}


def _load_all() -> None:
    # Importing the modules registers their queries.
    from tabkiln.plans import (  # noqa: F401
        q_boost,
        q_clean,
        q_ensemble,
        q_features,
        q_flows,
        q_hier,
        q_text,
        q_metrics,
        q_models,
        q_ordered,
        q_wide,
    )
