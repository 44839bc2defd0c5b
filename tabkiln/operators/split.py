"""Reproducible splits and tagged unions.

Splits rank rows by ``md5(seed || ':' || key)``: the order is a pure function
of the key, equal in Spark and in SQL engines, and independent of partitioning.
Exact sizes (``ceil(n * fraction)`` as in scikit-learn) come from the hash
value at the cut rank, found by ordering only the key range that holds it;
rows are then tagged by comparison, without ranking the whole table.

Rows that share a key are told apart by a hash of all their columns, so sizes
stay exact with repeated keys at every table size; only rows equal in every
column always fall on one side.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.operators.ordered import at_or_before, rank_cuts, row_hash
from tabkiln.session import write_shared


def union_tagged(parts: Mapping[str, DataFrame], col: str = "type") -> DataFrame:
    """UNION ALL by name with a tag column; columns missing in a part are NULL."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(col, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("nothing to union")
    return out


def hash_order(key: str, seed: int | str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


# The first 60 bits of the key's hash, then a hash of the whole row for rows that share a key.
_ORDER = ["_h60", "_tie"]


def _with_hash(df: DataFrame, key: str, seed: int | str) -> DataFrame:
    h60 = F.conv(F.substring(hash_order(key, seed), 1, 15), 16, 10).cast("long")
    return df.withColumns({"_h60": h60, "_tie": row_hash(df)})


def holdout_split(
    df: DataFrame, key: str, test_fraction: float = 0.2, seed: int | str = 120, out: str = "split"
) -> DataFrame:
    """Tag ``ceil(n * test_fraction)`` rows as ``test`` and the rest as ``train``.

    The rows are ordered by hash; the hash of the last test row is found once
    and every row is tagged by comparing with it: a projection, no shuffle of
    the table.  The table is written once with its hashes, so neither they nor
    what ``df`` is computed from (an imputer, say) is computed again by each pass
    of the search and each use of the two sides.
    """
    staged = write_shared(_with_hash(df, key, seed), "split")
    order = _ORDER
    n = staged.count()
    n_test = math.ceil(n * test_fraction)
    cuts, _ = rank_cuts(staged, order, [n_test], n=n)
    tag = F.when(at_or_before(staged, order, cuts[n_test]), "test").otherwise("train")
    return staged.withColumn(out, tag).drop(*_ORDER)


def three_way_split(
    df: DataFrame,
    key: str,
    holdout_fraction: float = 0.4,
    test_share: float = 0.5,
    seed: int | str = 42,
    out: str = "split",
) -> DataFrame:
    """train / val / test as two chained holdouts (U3): ``ceil(n*0.4)`` held out,
    ``ceil(held*0.5)`` of them test, the rest val."""
    staged = _with_hash(df, key, seed)
    order = _ORDER
    n = staged.count()
    held = math.ceil(n * holdout_fraction)
    n_test = math.ceil(held * test_share)
    cuts, _ = rank_cuts(staged, order, [n_test, held], n=n)
    tag = (
        F.when(at_or_before(staged, order, cuts[n_test]), "test")
        .when(at_or_before(staged, order, cuts[held]), "val")
        .otherwise("train")
    )
    return staged.withColumn(out, tag).drop(*_ORDER)


def split_by_group(
    df: DataFrame,
    group_key: str,
    test_fraction: float = 0.25,
    seed: int | str = 42,
    out: str = "split",
    groups: DataFrame | None = None,
) -> DataFrame:
    """Split whole groups (e.g. all segments of a document) to one side (U4).

    ``ceil(groups * fraction)`` distinct group keys go to test.  The cut is
    found on the distinct keys; the rows are then tagged by comparing their
    group's hash with it, so the big table is never joined or shuffled.
    ``groups`` names a smaller table with the same group keys to find them in.
    """
    # the distinct keys are cached only while the cut is found; the result needs just the cut
    keyed = df if groups is None else groups
    groups = _with_hash(keyed.select(group_key).distinct(), group_key, seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        order = ["_h60"]
        n = groups.count()
        n_test = math.ceil(n * test_fraction)
        cuts, _ = rank_cuts(groups, order, [n_test], n=n)
    finally:
        groups.unpersist()
    staged = _with_hash(df, group_key, seed)
    tag = F.when(at_or_before(staged, order, cuts[n_test]), "test").otherwise("train")
    return staged.withColumn(out, tag).drop(*_ORDER)
