"""Distributed learners: feature importance, k-fold regression, persistence.

Learners are MLlib estimators: every fit is a distributed job; only model
parameters (trees, importances: a few numbers per feature) reach the driver.
The fold loop runs on the driver over ``k`` folds (2 or 3 in practice) with
the training table persisted once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.classification import RandomForestClassifier, GBTClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tabkiln.operators.boosting import fit_boosted
from tabkiln.operators.ensemble import collate, collate_pretrained
from tabkiln.operators.ordered import assign_folds
from tabkiln.operators.metrics import regression_metrics
from tabkiln.operators.profile import column_roles
from tabkiln.session import write_shared


def _numeric(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


# Layout of a training table: partitions follow its rows, never the cluster.
ROWS_PER_PARTITION = 1_000_000
MIN_PARTITIONS = 16


def spread(
    df: DataFrame,
    key: str | None = None,
    rows_per_partition: int = ROWS_PER_PARTITION,
    min_partitions: int = MIN_PARTITIONS,
) -> DataFrame:
    """Training table laid out by a hash of ``key`` (else of all columns) and ordered within partitions.

    Tree learners draw their bagging samples per partition, so the same rows
    must meet in the same partition and order on every cluster, and again
    after a lost executor.  The partition count is a function of the row count
    alone.
    """
    by = [key] if key is not None else df.columns
    parts = max(min_partitions, math.ceil(df.count() / rows_per_partition))
    return df.repartition(parts, *by).sortWithinPartitions(*by)


DEFAULT_PARAMS = {
    "gbt": {"maxIter": 50, "stepSize": 0.1, "maxDepth": 5, "seed": 50},
    "rf": {"numTrees": 50, "maxDepth": 8, "seed": 50},
    "dt": {"maxDepth": 8, "seed": 50},
    "lr": {"maxIter": 50},
}


def regressor(learner: str, params: Mapping | None = None, features: str = "_features", label: str = "_label"):
    p = dict(DEFAULT_PARAMS.get(learner, {}))
    p.update(params or {})
    if learner == "gbt":
        return GBTRegressor(featuresCol=features, labelCol=label, **p)
    if learner == "rf":
        return RandomForestRegressor(featuresCol=features, labelCol=label, **p)
    if learner == "dt":
        return DecisionTreeRegressor(featuresCol=features, labelCol=label, **p)
    if learner == "lr":
        return LinearRegression(featuresCol=features, labelCol=label, **p)
    raise ValueError(f"unknown learner {learner}")


def categorical_features(df: DataFrame, features: Sequence[str], cat_threshold: int) -> list[str]:
    """Features with fewer than ``cat_threshold`` values that are not floating (the rule of ``column_roles``)."""
    return list(column_roles(df.select(*features), None, cat_threshold, exclude_float=True).categorical)


def _stages(features: Sequence[str], categorical: Sequence[str] = ()) -> list:
    """Assembly of ``features`` in order; categorical ones as indexed values, NULL and unseen values as one more."""
    ix = {c: f"_ix_{c}" for c in categorical}
    stages: list = []
    if ix:
        stages.append(
            StringIndexer(
                inputCols=list(ix), outputCols=list(ix.values()), handleInvalid="keep", stringOrderType="alphabetAsc"
            )
        )
    names = [ix.get(f, f) for f in features]
    return [*stages, VectorAssembler(inputCols=names, outputCol="_features", handleInvalid="keep")]


# --------------------------------------------------------------------------
# C3 / C4 feature importance
# --------------------------------------------------------------------------

def feature_importance(
    df: DataFrame,
    target: str,
    features: Sequence[str] | None = None,
    learner: str = "rf",
    limit: int | None = None,
    classify: bool = False,
    params: Mapping | None = None,
) -> DataFrame:
    """``(feature, importance)`` sorted by importance desc, ties by name.

    ``limit`` None or 0 keeps every feature.
    """
    feats = list(features) if features is not None else _numeric(df, [target])
    data = df.select(*feats, F.col(target).cast("double").alias("_label")).dropna(subset=["_label"])
    if classify:
        est = (RandomForestClassifier if learner == "rf" else GBTClassifier)(
            featuresCol="_features", labelCol="_label", seed=10, **(params or {})
        )
    else:
        est = regressor(learner, params)
    model = Pipeline(stages=[*_stages(feats), est]).fit(spread(data))
    imp = model.stages[-1].featureImportances.toArray().tolist()
    spark = df.sparkSession
    out = spark.createDataFrame([(f, float(v)) for f, v in zip(feats, imp)], "feature string, importance double")
    out = out.orderBy(F.col("importance").desc(), F.col("feature"))
    return out.limit(limit) if limit else out


def important_features(
    df: DataFrame,
    target: str,
    skip: Sequence[str] = (),
    learner: str = "rf",
    limit: int | None = None,
    params: Mapping | None = None,
) -> list[str]:
    """Feature names by importance without ``skip`` (C4; the plain exclusion)."""
    rows = feature_importance(df, target, None, learner, limit, params=params).collect()
    return [r["feature"] for r in rows if r["feature"] not in set(skip)]


# --------------------------------------------------------------------------
# M1 / M2 k-fold regression
# --------------------------------------------------------------------------

@dataclass
class CvResult:
    predictions: DataFrame | None  # (key, y_pred_<name>) for the test table, mean over folds
    oof: DataFrame  # (key, y_pred_<name>) out-of-fold for the train table
    importance: DataFrame  # (feature, importance) mean over folds
    metrics: DataFrame  # (fold, train, valid, n_trees); NULL where a fold has no such rows
    model: PipelineModel  # last fold's model, as the reference keeps
    features: list
    rounds: DataFrame  # (fold, round, train, valid, best): rounds of boosting with patience, else empty


@dataclass
class Folded:
    """A training table with its folds, assembled and persisted for all fits."""

    base: DataFrame  # (key, _features, _label, _fold)
    prep: PipelineModel
    features: list
    max_bins: int | None
    n_folds: int
    key: str


@contextmanager
def folded_table(
    train: DataFrame,
    key: str,
    target: str,
    features: Sequence[str] | None = None,
    n_folds: int = 2,
    cat_threshold: int | None = None,
) -> Iterator[Folded]:
    """Contiguous folds of ``train``, persisted while the block runs; learners share it.

    Features default to the numeric columns and, with ``cat_threshold``, the
    string columns of fewer values than that.  With ``cat_threshold`` integer
    and string features of fewer values are categorical for the trees; a
    string feature of more values raises.
    """
    feats = list(features) if features is not None else _numeric(train, [key, target])
    strings = [f.name for f in train.schema.fields if isinstance(f.dataType, StringType) and f.name not in (key, target)]
    if features is None and cat_threshold:
        feats += strings
    cats = categorical_features(train, feats, cat_threshold) if cat_threshold else []
    if features is None:
        feats = [f for f in feats if f not in strings or f in cats]
    if wide := [f for f in feats if f in strings and f not in cats]:
        raise ValueError(f"string features {wide} are not categorical at cat_threshold={cat_threshold}")
    prep = Pipeline(stages=_stages(feats, cats)).fit(train.select(*feats))
    rows = train.select(key, *feats, F.col(target).cast("double").alias("_label"))
    rows = rows.filter(F.col("_label").isNotNull() & ~F.isnan("_label"))  # a row without a label is in no fold
    folded = prep.transform(assign_folds(rows, key, n_folds, out="_fold"))
    base = spread(folded.select(key, "_features", "_label", "_fold"), key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield Folded(base, prep, feats, max(32, cat_threshold + 1) if cats else None, n_folds, key)
    finally:
        base.unpersist()


def _fit_fold(folded: Folded, k: int, learner: str, params: Mapping | None, early_stopping: bool) -> tuple:
    """The learner fitted on every fold but ``k``, its number of trees and its rounds (boosting with patience alone)."""
    p = dict(params or {})
    if folded.max_bins and learner != "lr":
        p.setdefault("maxBins", folded.max_bins)
    held = F.col("_fold") == k
    if "patience" in p:
        if learner != "gbt":
            raise ValueError("patience is a parameter of boosting ('gbt')")
        p = {**DEFAULT_PARAMS["gbt"], **p}
        rounds, step = p.pop("maxIter"), p.pop("stepSize")
        boosted = fit_boosted(folded.base, held, rounds=rounds, step=step, **p)
        return boosted.model, boosted.best_round, boosted.history
    fitted = _fit_plain(folded, learner, p, held, early_stopping)
    return fitted, len(fitted.trees) if hasattr(fitted, "trees") else None, []


def _fit_plain(folded: Folded, learner: str, p: dict, held: Column, early_stopping: bool):
    if learner == "gbt" and early_stopping:
        est = regressor(learner, {**p, "validationIndicatorCol": "_is_valid"})
        return est.fit(folded.base.withColumn("_is_valid", held))
    return regressor(learner, p).fit(folded.base.filter(~held))


def cv_regression(
    train: DataFrame,
    test: DataFrame | None,
    key: str,
    target: str,
    features: Sequence[str] | None = None,
    learner: str = "gbt",
    n_folds: int = 2,
    params: Mapping | None = None,
    name: str | None = None,
    cat_threshold: int | None = None,
    early_stopping: bool = True,
) -> CvResult:
    """Contiguous k-fold regression with out-of-fold and averaged test predictions.

    Metrics: per fold train and valid RMSE (one scoring pass for all folds); an
    ``overall`` row with the mean train RMSE and the R^2 of the out-of-fold
    predictions.  Boosting uses the valid fold for early stopping: with
    ``patience`` among its ``params`` it stops after so many rounds that are no
    better than the best one, which is kept (see :mod:`boosting`); without, it
    is MLlib's, which stops at the first round whose validation error gains less
    than ``validationTol`` (1 % unless ``params`` says otherwise).  Rows without
    a label take no part.  Without a test table there are no predictions.
    """
    with folded_table(train, key, target, features, n_folds, cat_threshold) as folded:
        return cv_folded(folded, test, learner, params, name, early_stopping)


def cv_folded(
    folded: Folded,
    test: DataFrame | None,
    learner: str,
    params: Mapping | None = None,
    name: str | None = None,
    early_stopping: bool = True,
) -> CvResult:
    """:func:`cv_regression` on folds made before, so that several learners share them."""
    name = name or learner
    key, base, feats, n_folds = folded.key, folded.base, folded.features, folded.n_folds
    spark = base.sparkSession
    imps, fits, trees, rounds = [], [], [], []
    for k in range(n_folds):
        fitted, n_trees, history = _fit_fold(folded, k, learner, params, early_stopping)
        fits.append(fitted)
        trees.append(n_trees)
        rounds += [(k, r, train, valid, r == n_trees) for r, train, valid in history]
        if hasattr(fitted, "featureImportances"):
            imps.append(fitted.featureImportances.toArray().tolist())
    # every fold's model scores the same scan of the training table; the scores are
    # written to the shared folder, so they no longer depend on the cached table
    scored = base
    for k, fitted in enumerate(fits):
        scored = fitted.transform(scored, {fitted.predictionCol: f"_p{k}"})
    own = F.coalesce(*[F.when(F.col("_fold") == k, F.col(f"_p{k}")) for k in range(n_folds)])
    scored = write_shared(scored.select(key, "_label", "_fold", own.alias("_p"), *[f"_p{k}" for k in range(n_folds)]), "scores")
    err2 = {k: F.pow(F.col(f"_p{k}") - F.col("_label"), 2) for k in range(n_folds)}
    parts = {"train": lambda k: F.col("_fold") != k, "valid": lambda k: F.col("_fold") == k}
    rmse = scored.agg(*[F.sqrt(F.avg(F.when(of(k), err2[k]))).alias(f"{part}{k}") for part, of in parts.items() for k in range(n_folds)]).first()
    rows = [(str(k), rmse[f"train{k}"], rmse[f"valid{k}"], trees[k]) for k in range(n_folds)]
    r2 = regression_metrics(scored, "_p", "_label").first()["r2"]
    known = [r[1] for r in rows if r[1] is not None]
    rows.append(("overall", sum(known) / len(known) if known else None, float(r2) if r2 is not None else None, None))
    oof = scored.select(key, F.col("_p").alias(f"y_pred_{name}"))
    predictions = None
    if test is not None:
        # every fold's model scores the same scan of the test table: no union, no shuffle
        scored = folded.prep.transform(test.select(key, *feats))
        for k, fitted in enumerate(fits):
            scored = fitted.transform(scored, {fitted.predictionCol: f"_p{k}"})
        mean = sum((F.col(f"_p{k}") for k in range(n_folds)), F.lit(0.0)) / F.lit(float(n_folds))
        predictions = scored.select(key, mean.alias(f"y_pred_{name}"))
    if imps:
        mean_imp = [sum(v[i] for v in imps) / len(imps) for i in range(len(feats))]
    else:
        mean_imp = [0.0] * len(feats)
    importance = spark.createDataFrame(list(zip(feats, [float(x) for x in mean_imp])), "feature string, importance double")
    metrics = spark.createDataFrame(rows, "fold string, train double, valid double, n_trees int")
    model = PipelineModel(stages=[*folded.prep.stages, fits[-1]])
    history = spark.createDataFrame(rounds, "fold int, round int, train double, valid double, best boolean")
    return CvResult(predictions, oof, importance, metrics, model, feats, history)


# --------------------------------------------------------------------------
# S5 / S6 / M3 persistence and scoring
# --------------------------------------------------------------------------

def save_model(model: PipelineModel, path: str) -> None:
    """Fitted pipeline with its feature list (the assembler holds the names)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_saved(df: DataFrame, models: Mapping[str, str], key: str) -> dict[str, DataFrame]:
    """Each saved model scores ``df``: ``{name: (key, y_pred_<name>)}`` (M3)."""
    out = {}
    for name, path in models.items():
        m = load_model(path)
        out[name] = m.transform(df).select(key, F.col("prediction").alias(f"y_pred_{name}"))
    return out


# --------------------------------------------------------------------------
# M8 end-to-end flows
# --------------------------------------------------------------------------

def fit_and_predict(
    train: DataFrame,
    test: DataFrame,
    key: str,
    target: str,
    learners: Mapping[str, Mapping] | Sequence[str] = ("gbt", "rf"),
    n_folds: int = 2,
    tolerance: float = 3.0,
    features: Sequence[str] | None = None,
) -> tuple[DataFrame, dict[str, CvResult]]:
    """Train with k-fold CV per learner, predict the test table, collate with truth (M8 train-test)."""
    specs = {n: {} for n in learners} if not isinstance(learners, Mapping) else dict(learners)
    results = {}
    with folded_table(train, key, target, features, n_folds) as folded:
        for name, params in specs.items():
            results[name] = cv_folded(folded, test, name, params, name)
    truth = test.select(key, target)
    return collate([r.predictions for r in results.values()], truth, tolerance, key, target), results


def fit_only(
    train: DataFrame,
    key: str,
    target: str,
    model_dir: str,
    learners: Mapping[str, Mapping] | Sequence[str] = ("gbt", "rf"),
    n_folds: int = 2,
    features: Sequence[str] | None = None,
) -> dict[str, str]:
    """Fit and save the last fold's model per learner, that one only (M8 train-only); returns model paths."""
    specs = {n: {} for n in learners} if not isinstance(learners, Mapping) else dict(learners)
    paths = {}
    with folded_table(train, key, target, features, n_folds) as folded:
        for name, params in specs.items():
            fitted, _, _ = _fit_fold(folded, n_folds - 1, name, params, True)
            path = f"{model_dir.rstrip('/')}/{name}"
            save_model(PipelineModel(stages=[*folded.prep.stages, fitted]), path)
            paths[name] = path
    return paths


def predict_only(df: DataFrame, key: str, model_paths: Mapping[str, str]) -> DataFrame:
    """Score with saved models and build the ensemble columns (M8 predict-only, M5)."""
    preds = score_saved(df, model_paths, key)
    return collate_pretrained(list(preds.values()), df.select(key), key)
