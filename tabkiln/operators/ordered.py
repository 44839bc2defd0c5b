"""Order-dependent operators without a single-task global window.

``Window.orderBy(key)`` without a partition moves every row into one task.
Instead the table is partitioned by ranges of its whole composite key, sorted
within the ranges and written once to the shared checkpoint folder together
with every row's place.  Spark itself compares the keys, so every orderable
type works alone or beside others: numbers of any width, strings, dates,
NULL (first) and NaN (last).  A hash of the whole row ends the key: rows that
share a key are ordered too, and a key that a third of the rows share is cut
into ranges like any other.

A per-range summary (row counts, last and first non-NULL values) becomes
offsets and carry values with a window over at most ``max_buckets`` rows,
which are broadcast back.  The written table is the one order all of these
jobs see, also after a lost executor.

Cut points (splits, folds) need no sorted table: the rows at a few ranks are
found by counting around sampled keys, in ever smaller brackets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, NullType, VariantType

from tabkiln.operators.project import _missing
from tabkiln.session import write_shared

# Ranges hold about ROWS_PER_BUCKET rows at scale; mid-size inputs are cut into
# up to default-parallelism ranges of at least MIN_ROWS_PER_BUCKET rows.
ROWS_PER_BUCKET = 2_000_000
MIN_ROWS_PER_BUCKET = 100_000
MAX_BUCKETS = 20_000
# Keys looked at to bracket a rank, and the size below which a bracket is ordered by one task.
SAMPLE_KEYS = 10_000
MAX_ORDERED_ROWS = 250_000
_B, _AT, _TIE = "_range_id", "_range_at", "_range_tie"
_PARTITION_BITS = 33  # monotonically_increasing_id: partition << 33 | row of the partition


def _keys(order_by: str | Sequence[str]) -> list[str]:
    return [order_by] if isinstance(order_by, str) else list(order_by)


def row_hash(df: DataFrame) -> Column:
    """Hash of the columns that can be hashed; rows that differ in none of them are interchangeable."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (MapType, NullType, VariantType))]
    return F.xxhash64(*hashed)


def with_ranges(
    df: DataFrame,
    order_by: str | Sequence[str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    max_buckets: int = MAX_BUCKETS,
    n: int | None = None,
) -> tuple[DataFrame, int]:
    """Add ``_range_id`` and ``_range_at``, whose order is that of the rows, and return the row count.

    More than one range means a written table; one range (small inputs) is
    ordered by a window when it is used.  Both order by the keys, then by a
    hash of the row, so the answer does not depend on the number of ranges.
    """
    keys = [F.col(k) for k in _keys(order_by)]
    n = df.count() if n is None else n
    by_size = math.ceil(n / max(1, rows_per_bucket))
    by_cores = min(df.sparkSession.sparkContext.defaultParallelism, n // MIN_ROWS_PER_BUCKET)
    n_buckets = int(min(max_buckets, max(1, by_size, by_cores)))
    keyed = df.withColumn(_TIE, row_hash(df))
    if n_buckets == 1:
        place = F.row_number().over(Window.partitionBy(_B).orderBy(*keys, _TIE)) - 1
        return keyed.withColumn(_B, F.lit(0)).withColumn(_AT, place.cast("long")).drop(_TIE), n
    placed = (
        keyed.repartitionByRange(n_buckets, *keys, F.col(_TIE))
        .sortWithinPartitions(*keys, _TIE)
        .drop(_TIE)
        .withColumn(_AT, F.monotonically_increasing_id())
    )
    written = write_shared(placed, "ranges")
    first = F.shiftleft(F.shiftright(_AT, _PARTITION_BITS), _PARTITION_BITS)
    ranged = written.withColumn(_B, F.shiftright(_AT, _PARTITION_BITS).cast("int")).withColumn(_AT, F.col(_AT) - first)
    return ranged, n


def add_row_index(
    df: DataFrame,
    order_by: str | Sequence[str],
    out: str = "row_index",
    start: int = 1,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Consecutive index ``start, start+1, ...`` in the order of ``order_by``.

    Rows that share the order keys are ordered by a hash of the row.
    """
    ranged, _ = with_ranges(df, order_by, rows_per_bucket)
    counts = ranged.groupBy(_B).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_B, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # At most max_buckets rows: a proven bound for the broadcast.
    joined = ranged.join(F.broadcast(offsets), _B)
    return joined.withColumn(out, (F.col("_offset") + F.col(_AT) + F.lit(start)).cast("long")).drop(_B, _AT, "_offset")


def fill_forward_backward(
    df: DataFrame,
    order_by: str | Sequence[str],
    cols: Sequence[str],
    forward: bool = True,
    backward: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Forward fill then backward fill of ``cols`` along ``order_by``.

    Like pandas ``ffill().bfill()``: leading NULLs take the first value that
    follows them, and NaN counts as missing.  Cells that nothing can fill are
    NULL.
    """
    ranged, _ = with_ranges(df, order_by, rows_per_bucket)
    summary_aggs = []
    for c in cols:
        present = F.when(~_missing(df, c), F.struct(_AT, F.col(c).alias("_v")))
        at = F.when(~_missing(df, c), F.col(_AT))
        summary_aggs.append(F.max_by(present, at).alias(f"_last_{c}"))
        summary_aggs.append(F.min_by(present, at).alias(f"_first_{c}"))
    summary = ranged.groupBy(_B).agg(*summary_aggs)
    # Running frames only (unbounded preceding .. current/previous row): Spark
    # evaluates them in one pass, whereas a frame reaching "unbounded following"
    # is re-evaluated for every row.  The backward direction therefore runs as
    # a forward frame over the reversed order.
    before = Window.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.col(_B).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = [F.col(_B)]
    for c in cols:
        carry_cols.append(F.last(F.col(f"_last_{c}._v"), ignorenulls=True).over(before).alias(f"_in_{c}"))
        carry_cols.append(F.last(F.col(f"_first_{c}._v"), ignorenulls=True).over(after).alias(f"_out_{c}"))
    carries = summary.select(*carry_cols)
    # At most max_buckets rows: a proven bound for the broadcast.
    joined = ranged.join(F.broadcast(carries), _B)
    upto = Window.partitionBy(_B).orderBy(_AT).rowsBetween(Window.unboundedPreceding, 0)
    upto_rev = Window.partitionBy(_B).orderBy(F.col(_AT).desc()).rowsBetween(Window.unboundedPreceding, 0)
    filled = {}
    for c in cols:
        own = F.when(~_missing(df, c), F.col(c))
        v = own
        if forward:
            v = F.coalesce(v, F.last(own, ignorenulls=True).over(upto), F.col(f"_in_{c}"))
        if backward:
            v = F.coalesce(v, F.last(own, ignorenulls=True).over(upto_rev), F.col(f"_out_{c}"))
        filled[c] = v
    out = joined.withColumns(filled)
    return out.drop(_B, _AT, *[f"_in_{c}" for c in cols], *[f"_out_{c}" for c in cols])


def _literal_row(df: DataFrame, order: Sequence[str], values: tuple) -> Column:
    """The values as a struct of the columns' own types."""
    return F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, values)])


def _ordered_at(rows: DataFrame, order: list[str], ranks: Sequence[int]) -> dict[int, tuple]:
    """Keys of the rows at the given ranks of a small table."""
    placed = rows.withColumn(_AT, F.row_number().over(Window.orderBy(*[F.col(c) for c in order])))
    found = placed.filter(F.col(_AT).isin(list(ranks))).select(_AT, *order).collect()
    return {r[_AT]: tuple(r[c] for c in order) for r in found}


def rank_cuts(
    df: DataFrame,
    order: Sequence[str],
    ranks: Sequence[int],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    n: int | None = None,
) -> tuple[dict, int]:
    """Order-key values of the rows at the given 1-based ranks, and the row count.

    Around each rank two or three keys of a sample are counted exactly (one
    aggregate for all ranks that share a bracket).  A counted key whose rows
    hold the rank is the answer, however many rows share it; else the rank lies
    between two of them and the search goes on there.  A bracket of at most
    ``rows_per_bucket`` rows (and ``MAX_ORDERED_ROWS``) is ordered.  With unique
    order keys, ``at_or_before(df, order, cuts[r])`` holds for exactly the first
    ``r`` rows.
    """
    order = list(order)
    keys = df.select(*order)
    n = keys.count() if n is None else n
    cuts: dict = {r: None for r in ranks}
    small = min(rows_per_bucket, MAX_ORDERED_ROWS)
    row = F.struct(*[F.col(c) for c in order])
    # a bracket: above this key and below that one (None: no bound), rows before it, rows in it; and its ranks
    brackets: dict[tuple, set[int]] = {(None, None, 0, n): {r for r in ranks if 0 < r <= n}}
    while brackets:
        (low, high, below, inside), wanted = brackets.popitem()
        if not wanted:
            continue
        rows = keys
        if low is not None:
            rows = rows.filter(row > _literal_row(df, order, low))
        if high is not None:
            rows = rows.filter(row < _literal_row(df, order, high))
        sample = []
        if inside > small:
            share = min(1.0, SAMPLE_KEYS / inside)
            sample = [tuple(r) for r in rows.sample(share, seed=17).orderBy(*order).collect()]
        if not sample:
            found = _ordered_at(rows, order, [r - below for r in wanted])
            cuts.update({r: found[r - below] for r in wanted})
            continue
        m, slack = len(sample), 3 * math.sqrt(len(sample))
        places = {min(max(int(p), 0), m - 1) for r in wanted for at in [(r - below) / inside * m] for p in (at - slack, at, at + slack)}
        pivots = [sample[p] for p in sorted(places)]
        aggs = []
        for i, pivot in enumerate(pivots):
            lit = _literal_row(df, order, pivot)
            aggs += [F.count(F.when(row < lit, 1)).alias(f"lt{i}"), F.count(F.when(row <= lit, 1)).alias(f"le{i}")]
        counted = rows.agg(*aggs).first()
        spans = [(counted[f"lt{i}"], counted[f"le{i}"]) for i in range(len(pivots))]
        for r in wanted:
            local = r - below
            hit = next((p for p, (lt, le) in zip(pivots, spans) if lt < local <= le), None)
            if hit is not None:
                cuts[r] = hit
                continue
            before = max(((le, p) for p, (_, le) in zip(pivots, spans) if le < local), key=lambda x: x[0], default=(0, low))
            after = min(((lt, p) for p, (lt, _) in zip(pivots, spans) if lt >= local), key=lambda x: x[0], default=(inside, high))
            brackets.setdefault((before[1], after[1], below + before[0], after[0] - before[0]), set()).add(r)
    return cuts, n


def at_or_before(df: DataFrame, order: Sequence[str], cut: tuple | None) -> Column:
    """Whether a row of ``df`` lies at or before a cut of :func:`rank_cuts`."""
    if cut is None:
        return F.lit(False)
    return F.struct(*[F.col(c) for c in order]) <= _literal_row(df, order, cut)


def assign_folds(
    df: DataFrame,
    order_by: str | Sequence[str],
    k: int,
    out: str = "fold",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Unshuffled K-fold assignment in key order (W4), same sizes as ``KFold(shuffle=False)``.

    The first ``n % k`` folds hold one extra row.  The keys at the k-1 fold
    boundaries are found with :func:`rank_cuts`; each row's fold is the number
    of boundaries it lies after: a projection that keeps the partitioning.
    The order keys must be unique.
    """
    if k < 2:
        raise ValueError("k must be at least 2")
    keys = _keys(order_by)
    n = df.count()
    if n < k:
        raise ValueError(f"cannot split {n} rows into {k} folds")
    b, r = divmod(n, k)
    ends, total = [], 0
    for i in range(k - 1):
        total += b + 1 if i < r else b
        ends.append(total)
    cuts, _ = rank_cuts(df, keys, ends, rows_per_bucket, n=n)
    fold = sum((F.when(at_or_before(df, keys, cuts[e]), 0).otherwise(1) for e in ends), F.lit(0))
    return df.withColumn(out, fold.cast("int"))
