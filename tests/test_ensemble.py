import pytest
from pyspark.sql import functions as F

from tabkiln.operators import ensemble


def test_collate_flags_and_ensembles(spark):
    truth = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "id long, y double")
    a = spark.createDataFrame([(1, 13.0), (2, 24.0), (3, None)], "id long, y_pred_a double")
    b = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id long, y_pred_b double")
    rows = {r.id: r for r in ensemble.collate([a, b], truth, tolerance=3).collect()}
    assert rows[1].result_a == 1  # error equal to the tolerance counts as correct
    assert rows[2].result_a == 0
    assert rows[3].result_a == 1  # missing prediction: NULL error falls to 1
    assert rows[1].y_pred_comb_median == 11.5
    assert rows[3].y_pred_comb_mean is None
    acc = {r.result: r.accuracy for r in ensemble.tolerance_accuracy(ensemble.collate([a, b], truth)).collect()}
    assert acc["result_b"] == 1.0


def test_duplicate_key_raises(spark):
    truth = spark.createDataFrame([(1, 10.0)], "id long, y double")
    a = spark.createDataFrame([(1, 13.0), (1, 14.0)], "id long, y_pred_a double")
    with pytest.raises(Exception, match="duplicate key"):
        ensemble.collate([a], truth).collect()


def test_single_model_has_no_ensembles(spark):
    truth = spark.createDataFrame([(1, 10.0)], "id long, y double")
    a = spark.createDataFrame([(1, 13.0)], "id long, y_pred_a double")
    cols = ensemble.collate([a], truth).columns
    assert not any("comb" in c for c in cols)


def test_nan_follows_numpy_comparisons(spark):
    from tabkiln.functions import binarize, tolerance_flag

    df = spark.createDataFrame([(float("nan"),), (None,), (0.7,), (0.2,)], "p double")
    got = [tuple(r) for r in df.select(binarize("p", 0.5), tolerance_flag("p", 0.5)).collect()]
    assert got == [(0, 1), (0, 1), (1, 0), (0, 1)]


def test_row_statistics_skip_nan(spark):
    from tabkiln.functions import row_max, row_mean, row_median, row_min

    df = spark.createDataFrame([(float("nan"), 2.0, 4.0)], "a double, b double, c double")
    r = df.select(row_max(["a", "b", "c"]), row_min(["a", "b", "c"]), row_mean(["a", "b", "c"]), row_median(["a", "b", "c"])).first()
    assert tuple(r) == (4.0, 2.0, 3.0, 3.0)
