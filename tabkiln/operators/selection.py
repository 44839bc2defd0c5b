"""Exact medians of groups of any size (A9, §2.16).

``percentile`` keeps every distinct value of a group in one buffer.  Here a
group's middle ranks are found by histograms: the values between two bounds
fall into buckets, one aggregate counts them per (group, bucket), and the
bucket that holds the ranks becomes the next pair of bounds.  An aggregate's
buffers hold a count and two values a bucket, so a group with a third of the
rows is reduced before the shuffle like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkiln.operators.project import _missing, _q
from tabkiln.session import write_shared

BUCKETS = 1024


def _place(v: Column, lo: Column, hi: Column, logarithmic: bool, buckets: int) -> Column:
    """Bucket of a value between finite or infinite bounds, never falling as the value grows.

    Equal widths, or equal widths of sign * log(1 + |v|): values of every size are apart after one round of either.
    """
    def scaled(x: Column) -> Column:
        return F.signum(x) * F.log1p(F.abs(x)) if logarithmic else x / 2  # halves: no difference overflows

    top = float(buckets - 1)
    width = scaled(hi) - scaled(lo)
    share = F.try_divide(scaled(v) - scaled(lo), F.nullif(width, F.lit(0.0)))
    inside = F.least(F.greatest(F.floor(F.coalesce(share, F.lit(0.0)) * buckets), F.lit(0.0)), F.lit(top))
    return F.when(v == float("-inf"), -1).when(v == float("inf"), buckets).otherwise(inside).cast("int")


def group_median(df: DataFrame, by: Sequence[str], value: str, out: str = "median", buckets: int = BUCKETS) -> DataFrame:
    """``(*by, n, median)`` for every group of ``df``, exact; ``n`` counts the values present.

    NULL and NaN are missing; a group without values has a NULL median.  A NULL
    in ``by`` is a group like any other.  An even number of values gives the
    mean of the middle two.  Rounds go on until every group is settled: about
    one for each factor ``buckets`` of a group's size, and at most eight or so
    for values of any spread.
    """
    by = list(by)
    names = [f"_g{i}" for i in range(len(by))]
    present = F.when(~_missing(df, value), _q(value).cast("double"))
    rows = df.select(*[_q(c).alias(g) for c, g in zip(by, names)], present.alias("_v"))
    state = rows.groupBy(*names).agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    state = write_shared(state.selectExpr(*names, "n", "lo", "hi", "(n + 1) div 2 AS r1", "n div 2 + 1 AS r2"), "median")
    settled = [state.filter("n = 0 OR lo = hi").select(*names, "n", F.col("lo").alias(out))]
    left = state.filter("n > 0 AND lo < hi")
    values = rows.filter("_v IS NOT NULL")
    turn = 0
    while not left.isEmpty():
        bounds = left.select(*[F.col(g).alias(f"{g}_") for g in names], "n", "lo", "hi", "r1", "r2")
        same_group = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"{g}_")) for g in names], F.lit(True))
        # infinite values stand in buckets of their own, finite ones between the finite bounds
        finite = lambda c, end: F.when(F.col(c).isin(float("inf"), float("-inf")), F.lit(end)).otherwise(F.col(c))
        v, lo, hi = F.col("_v"), finite("lo", -1.7976931348623157e308), finite("hi", 1.7976931348623157e308)
        inside = values.join(bounds, same_group).filter("_v >= lo AND _v <= hi")
        placed = inside.withColumn("bucket", _place(v, lo, hi, turn % 2 == 1, buckets))
        counts = placed.groupBy(*names, "n", "r1", "r2", "bucket").agg(
            F.count(F.lit(1)).alias("c"), F.min("_v").alias("least"), F.max("_v").alias("most"))
        upto = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        ranked = counts.withColumn("after", F.sum("c").over(upto)).withColumn("before", F.col("after") - F.col("c"))
        cell = F.struct("before", "least", "most")
        found = ranked.groupBy(*names, "n", "r1", "r2").agg(*[
            F.max(F.when((F.col("before") < F.col(r)) & (F.col(r) <= F.col("after")), cell)).alias(f"at_{r}") for r in ("r1", "r2")])
        one = F.col("at_r1.before") == F.col("at_r2.before")
        middle = F.when(one, F.when(F.col("at_r1.least") == F.col("at_r1.most"), F.col("at_r1.least"))).otherwise(
            F.col("at_r1.most") / 2 + F.col("at_r2.least") / 2)
        found = write_shared(found.withColumns({"open": one & (F.col("at_r1.least") < F.col("at_r1.most")), out: middle}), "median")
        settled.append(found.filter("NOT open").select(*names, "n", out))
        left = found.filter("open").select(
            *names, "n", F.col("at_r1.least").alias("lo"), F.col("at_r1.most").alias("hi"),
            (F.col("r1") - F.col("at_r1.before")).alias("r1"), (F.col("r2") - F.col("at_r1.before")).alias("r2"))
        turn += 1
    result = reduce(DataFrame.unionByName, settled)
    return result.select(*[F.col(g).alias(c) for c, g in zip(by, names)], "n", out)
