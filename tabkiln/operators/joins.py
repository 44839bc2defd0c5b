"""Key joins used to put columns back together.

The reference aligns frames by position; here every alignment needs a
declared key.  Joins are left to the optimizer: AQE measures the sizes at
runtime, broadcasts a side under ``autoBroadcastJoinThreshold`` and splits
skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_back_columns(df: DataFrame, source: DataFrame, key: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Bring ``cols`` from ``source`` back onto ``df`` by key, keeping every row of ``df``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(source.select(*keys, *cols), keys, "left")


def first_per_key(df: DataFrame, key: str, order: str, cols: Sequence[str]) -> DataFrame:
    """Columns of the first row (smallest ``order``) of each key.

    ``min_by`` is a partial aggregate, so a key holding a third of all rows is
    reduced map-side before the shuffle.
    """
    picked = F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(order)).alias("_first")
    return df.groupBy(key).agg(picked).select(key, *[F.col(f"_first.{c}").alias(c) for c in cols])


def attach_per_group(df: DataFrame, per_group: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a per-group table (thresholds, offsets) onto the rows of its groups.

    Lazy: the table is an aggregate, whose size AQE measures before it picks a
    broadcast (the big side then stays where it is) or a shuffled join.
    """
    return df.join(per_group, list(on), how)
