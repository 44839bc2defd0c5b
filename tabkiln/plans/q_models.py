"""Queries for imputation, feature importance and k-fold learners (step 9).

Learner outputs depend on MLlib's training algorithms, so most of these are
rows-only checks; the unit tests bound their quality.  The partition and
write-back steps of imputation are exact and have oracles.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.operators import impute, models, split
from tabkiln.plans import fixtures as fx
from tabkiln.plans.registry import register
from tabkiln.session import checkpoint_dir

_FEATS = ["x1", "x3", "c1"]
_GBT = {"maxIter": 20, "maxDepth": 4}
_RF = {"numTrees": 20, "maxDepth": 6}


_PART_SQL = f"""WITH {fx.REG_SQL},
np AS (SELECT id, x3, n2 FROM reg WHERE n1 IS NULL)
SELECT id, x3,
  coalesce(n2,
           last_value(n2 IGNORE NULLS) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(n2 IGNORE NULLS) OVER (ORDER BY id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS n2
FROM np"""


@register("impute_partition", _PART_SQL, doubles=["x3", "n2"])
def impute_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to impute for n1, features filled forward then backward in key order."""
    r = fx.reg(spark, sf_dir).select("id", "x3", "n1", "n2")
    _, to_pred = impute.impute_partition(r, "n1", "id", ["x3", "n2"])
    return to_pred


_TRAIN_SQL = f"""WITH {fx.REG_SQL}
SELECT id, x3, n2, n1 FROM reg WHERE n1 IS NOT NULL AND n2 IS NOT NULL"""


@register("impute_train_rows", _TRAIN_SQL, doubles=["x3", "n2", "n1"])
def impute_train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows for n1 are the rows without any NULL."""
    r = fx.reg(spark, sf_dir).select("id", "x3", "n1", "n2")
    train, _ = impute.impute_partition(r, "n1", "id", ["x3", "n2"])
    return train


_WB_SQL = f"""WITH {fx.REG_SQL}
SELECT id, y, coalesce(n1, x3 * 2.0) AS n1 FROM reg"""


@register("impute_writeback", _WB_SQL, doubles=["y", "n1"])
def impute_writeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions joined by key fill only the NULL cells."""
    r = fx.reg(spark, sf_dir).select("id", "y", "x3", "n1")
    preds = r.filter(F.col("n1").isNull()).select("id", (F.col("x3") * 2.0).alias("prediction"))
    return impute.write_back(r, preds, "id", "n1").select("id", "y", "n1")


_SIMPLE_SQL = f"""WITH {fx.REG_SQL}
SELECT id, coalesce(n1, avg(n1) OVER ()) AS n1 FROM reg"""


@register("simple_impute", _SIMPLE_SQL, doubles=["n1"])
def simple_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean imputation baseline (ml.feature.Imputer)."""
    r = fx.reg(spark, sf_dir).select("id", "n1")
    return impute.simple_impute(r, ["n1"], "mean")


@register("impute_rf")
def impute_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random-forest imputation of n1 then n2, earlier columns feeding later ones."""
    r = fx.reg(spark, sf_dir).select("id", "x1", "x3", "c1", "n1", "n2")
    out = impute.model_impute(r, ["n1", "n2"], "id", learner="rf", num_trees=10, max_depth=6)
    return out.select("id", "n1", "n2")


@register("impute_dt_categorical")
def impute_dt_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision-tree classifier imputation of a categorical label."""
    n = fx.nullable(spark, sf_dir).select("doc_id", "n_chars", "quality")
    out = impute.model_impute(n, ["quality"], "doc_id", learner="dt", categorical=True, features=["n_chars"], max_depth=5)
    return out.select("doc_id", "quality")


@register("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random-forest importances sorted descending, top 3."""
    r = fx.reg(spark, sf_dir).select("y", "x1", "x3", "c1", "k")
    return models.feature_importance(r, "y", ["x1", "x3", "c1", "k"], "rf", limit=3, params=_RF)


def _split(spark: SparkSession, sf_dir: str):
    r = fx.reg(spark, sf_dir).select("id", "y", *_FEATS)
    tagged = split.holdout_split(r, "id", 0.2, seed=120)
    return tagged.filter("split = 'train'").drop("split"), tagged.filter("split = 'test'").drop("split")


@register("cv_regression")
def cv_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2-fold GBT with early stopping, test predictions averaged over folds."""
    train, test = _split(spark, sf_dir)
    res = models.cv_regression(train, test, "id", "y", _FEATS, "gbt", 2, _GBT, name="gbt")
    return res.predictions


@register("cv_metrics")
def cv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-fold train/valid RMSE and trees kept; overall row with OOF R^2."""
    train, test = _split(spark, sf_dir)
    res = models.cv_regression(train, test, "id", "y", _FEATS, "rf", 2, _RF, name="rf", cat_threshold=20)
    return res.metrics


@register("load_predict")
def load_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved models reloaded to score a table and build ensemble columns."""
    train, test = _split(spark, sf_dir)
    model_dir = f"{checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex}"
    paths = models.fit_only(train, "id", "y", model_dir, {"gbt": _GBT, "rf": _RF}, 2, _FEATS)
    return models.predict_only(test, "id", paths)


@register("fit_predict_collate")
def fit_predict_collate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8/M4: train two learners with k-fold CV, predict the test split, collate with tolerance flags."""
    train, test = _split(spark, sf_dir)
    collated, _ = models.fit_and_predict(train, test, "id", "y", {"gbt": _GBT, "rf": _RF}, 2, 3.0, _FEATS)
    return collated


@register("cv_importance")
def cv_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature importance averaged over the folds of a k-fold fit."""
    train, _ = _split(spark, sf_dir)
    res = models.cv_regression(train, None, "id", "y", _FEATS, "rf", 2, _RF, name="rf")
    return res.importance


@register("important_features")
def important_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: feature names by importance with skipped columns removed."""
    r = fx.reg(spark, sf_dir).select("y", "x1", "x3", "c1", "k")
    names = models.important_features(r, "y", skip=["k"], learner="rf", params=_RF)
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "rank int, feature string")


@register("feature_importance_classifier")
def feature_importance_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier importances for a 0/1 target (labelled documents), sorted descending."""
    d = fx.t(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = fx.t(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id").select("n_chars", "toxic", "quality", (F.col("doc_id") % 7).alias("k7"))
    return models.feature_importance(j, "quality", ["n_chars", "toxic", "k7"], "rf", classify=True, params={"numTrees": 20})
