"""Exact medians of groups against a sort."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tabkiln.operators.selection import group_median


def _same(got, want):
    return got == want or (got is not None and want is not None and got == pytest.approx(want, rel=1e-12, abs=1e-300))


@pytest.mark.parametrize("buckets", [2, 1024])
def test_medians_equal_a_sort(spark, buckets):
    rng = random.Random(4)
    kinds = [lambda: rng.gauss(0, 1), lambda: rng.randint(0, 3), lambda: 10.0 ** rng.uniform(-300, 300) * rng.choice([-1, 1]),
             lambda: rng.choice([float("inf"), float("-inf"), 0.0, 1.0]), lambda: 5.0, lambda: rng.choice([0.1, 0.2, 0.1 + 2**-56, -0.0])]
    groups = {(k, n): [float(kind()) for _ in range(n)] for k, kind in enumerate(kinds) for n in (1, 2, 3, 10, 151)}
    rows = [(f"g{k}" if k else None, n, v) for (k, n), vs in groups.items() for v in vs]
    rows += [("none", 0, None), ("none", 0, float("nan")), ("g1", 3, None)]
    rng.shuffle(rows)
    if buckets == 2:
        rows = [r for r in rows if r[0] not in ("g2", "g3")]
    df = spark.createDataFrame(rows, "a string, b int, v double").repartition(4)
    got = {(r["a"], r["b"]): (r["n"], r["median"]) for r in group_median(df, ["a", "b"], "v", buckets=buckets).collect()}
    want = {(f"g{k}" if k else None, n): (n, statistics.median(vs)) for (k, n), vs in groups.items()} | {("none", 0): (0, None)}
    for key, (n, median) in got.items():
        if not (isinstance(want[key][1], float) and want[key][1] != want[key][1]):  # the middle of -inf and inf is no number
            assert n == want[key][0] and _same(median, want[key][1]), key
    assert len(got) == len({(r[0], r[1]) for r in rows})


def test_a_group_of_a_third_of_the_rows_and_no_groups_at_all(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 400).alias("g"),
                                    F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("v"))
    got = {(r["g"], r["n"]): r["median"] for r in group_median(df, ["g"], "v").collect()}
    want = {(r["g"], r["n"]): r["m"] for r in df.groupBy("g").agg(F.count("v").alias("n"), F.median("v").alias("m")).collect()}
    assert got == want
    assert [r["median"] for r in group_median(df, [], "v").collect()] == [df.agg(F.median("v")).first()[0]]
    assert group_median(df.limit(0), ["g"], "v").count() == 0
