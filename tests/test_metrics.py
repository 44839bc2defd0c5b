"""Histogram threshold tuning equals a brute-force sweep."""

import random

from pyspark.sql import functions as F

from tabkiln.operators import metrics


def _brute(rows, grid, inclusive, need_both, default):
    best = {}
    for cat in sorted({r[0] for r in rows}):
        sub = [(p, y) for c, p, y in rows if c == cat]
        bf, bt = (0.0 if need_both else -1.0), default
        for t in grid:
            pred = [1 if (p >= t if inclusive else p > t) else 0 for p, _ in sub]
            tp = sum(1 for (p, y), q in zip(sub, pred) if q == 1 and y == 1)
            fp = sum(1 for (p, y), q in zip(sub, pred) if q == 1 and y == 0)
            fn = sum(1 for (p, y), q in zip(sub, pred) if q == 0 and y == 1)
            f1 = 0.0 if 2 * tp + fp + fn == 0 else 2 * tp / (2 * tp + fp + fn)
            if need_both and not (len(set(pred)) > 1 and len({y for _, y in sub}) > 1):
                continue
            if f1 > bf:
                bf, bt = f1, t
        best[cat] = bt
    return best


def test_tuning_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(f"c{rnd.randint(0, 4)}", round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(400)]
    rows += [("const", 0.3, 0), ("const", 0.7, 0)]
    df = spark.createDataFrame(rows, "cat string, p double, y int")
    for grid, inclusive, need_both, default in (
        (metrics.CATEGORY_GRID, False, False, 0.5),
        (metrics.LABEL_GRID, True, True, 0.5),
        (metrics.LABEL_GRID_FINE, True, True, 0.5),
    ):
        got = {
            r["cat"]: r["threshold"]
            for r in metrics.tune_thresholds(df, "p", "y", ["cat"], grid, inclusive, need_both, default).collect()
        }
        assert got == _brute(rows, grid, inclusive, need_both, default)


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "p double, y int")
    r = metrics.binary_metrics(df, "p", "y", 0.5).first()
    assert (r["precision"], r["recall"], r["f1"], r["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_tuned_f1_not_below_any_grid_point(spark):
    rnd = random.Random(11)
    rows = [(f"c{rnd.randint(0, 2)}", rnd.random(), rnd.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "cat string, p double, y int")
    sweep = metrics.threshold_sweep(df, "p", "y", ["cat"], metrics.CATEGORY_GRID)
    best = {r["cat"]: r["f1"] for r in metrics.tune_thresholds(df, "p", "y", ["cat"]).collect()}
    worst_gap = sweep.groupBy("cat").agg(F.max("f1").alias("m")).collect()
    for r in worst_gap:
        assert best[r["cat"]] == r["m"]


def test_grid_bucket_equals_count(spark):
    rnd = random.Random(5)
    vals = [rnd.random() for _ in range(500)] + [g for g in metrics.CATEGORY_GRID] + [g for g in metrics.LABEL_GRID]
    vals += [0.0, 1.0, -0.5, 1.5, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    for grid in (metrics.CATEGORY_GRID, metrics.LABEL_GRID, metrics.LABEL_GRID_FINE):
        for inclusive in (False, True):
            got = [r[0] for r in df.select(metrics.grid_bucket("p", grid, inclusive)).collect()]
            for v, b in zip(vals, got):
                if v is None or v != v:
                    exp = 0
                else:
                    exp = sum(1 for g in grid if (v >= g if inclusive else v > g))
                assert b == exp, (v, b, exp, inclusive)


def test_row_median_with_nulls(spark):
    from tabkiln.functions import row_median

    df = spark.createDataFrame([(1.0, None, 3.0, 10.0), (None, None, None, None), (5.0, 1.0, None, None), (2.0, 9.0, 4.0, None)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(row_median(["a", "b", "c", "d"])).collect()]
    assert got == [3.0, None, 3.0, 4.0]
