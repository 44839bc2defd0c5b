"""Learner contracts: shapes plus a metric bound (learner parity is not a goal)."""

from pyspark.sql import functions as F

from tabkiln.operators import impute, models
from tabkiln.plans import fixtures as fx

from conftest import SF


def test_cv_beats_mean_predictor(spark):
    r = fx.reg(spark, SF).select("id", "y", "x1", "x3", "c1")
    train = r.filter("id % 5 != 0")
    test = r.filter("id % 5 = 0")
    res = models.cv_regression(train, test, "id", "y", ["x1", "x3", "c1"], "gbt", 2, {"maxIter": 15, "maxDepth": 4})
    m = {row["fold"]: row for row in res.metrics.collect()}
    assert set(m) == {"0", "1", "overall"}
    assert m["overall"]["valid"] > 0.9  # OOF R^2 on a planted linear signal
    joined = res.predictions.join(test, "id")
    rmse = joined.select(F.sqrt(F.avg(F.pow(F.col("y_pred_gbt") - F.col("y"), 2)))).first()[0]
    std = test.select(F.stddev_pop("y")).first()[0]
    assert rmse < 0.3 * std
    assert res.predictions.count() == test.count()


def test_importance_sorted_and_limited(spark):
    r = fx.reg(spark, SF).select("y", "x1", "x3", "c1")
    imp = models.feature_importance(r, "y", ["x1", "x3", "c1"], "rf", limit=2, params={"numTrees": 10}).collect()
    assert len(imp) == 2
    assert imp[0]["feature"] == "x1"
    assert imp[0]["importance"] >= imp[1]["importance"]


def test_model_impute_fills_only_nulls(spark):
    r = fx.reg(spark, SF).select("id", "x1", "x3", "c1", "n1")
    out = impute.model_impute(r, ["n1"], "id", learner="dt", max_depth=4)
    assert out.filter(F.col("n1").isNull()).count() == 0
    changed = out.alias("o").join(r.alias("r"), "id").filter(
        F.col("r.n1").isNotNull() & (F.col("o.n1") != F.col("r.n1"))
    )
    assert changed.count() == 0
    assert out.count() == r.count()


def test_categorical_impute_keeps_label_values(spark):
    n = fx.nullable(spark, SF).select("doc_id", "n_chars", "quality")
    out = impute.model_impute(n, ["quality"], "doc_id", learner="rf", categorical=True, features=["n_chars"], num_trees=5)
    vals = {r[0] for r in out.select("quality").distinct().collect()}
    assert vals <= {0, 1}


def test_important_features_plain_exclusion(spark):
    r = fx.reg(spark, SF).select("y", "x1", "x3", "c1", "k")
    names = models.important_features(r, "y", skip=["k", "c1"], learner="rf", params={"numTrees": 5})
    assert sorted(names) == ["x1", "x3"]  # every other feature once, skipped ones gone


def test_predict_only_reloads_and_ensembles(spark, tmp_path):
    r = fx.reg(spark, SF).select("id", "y", "x1", "x3")
    train = r.filter("id % 4 != 0")
    test = r.filter("id % 4 = 0")
    paths = models.fit_only(train, "id", "y", str(tmp_path), {"rf": {"numTrees": 5}, "dt": {"maxDepth": 4}}, 2, ["x1", "x3"])
    out = models.predict_only(test, "id", paths)
    assert set(out.columns) == {
        "id", "y_pred_rf", "y_pred_dt", "y_pred_comb_max", "y_pred_comb_min", "y_pred_comb_mean", "y_pred_comb_median"
    }
    assert out.count() == test.count()
    assert out.filter(F.col("y_pred_comb_max") < F.col("y_pred_comb_min")).count() == 0
