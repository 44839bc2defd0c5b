"""Model-based NULL imputation.

Two forms.  ``fit_imputer`` learns one model per column, in order, and gives a
chain that can be saved and applied to any table: a projection, row by row,
that never looks at other rows of the table it fills.  ``model_impute`` fills
one table by itself, with features filled along its own key:

For each column with NULLs, in order: the complete rows train a learner on
the other columns, the rows where the column is NULL get their features
filled along the key (forward then backward) and are scored, and the
predictions are written back into the NULL cells only.  Earlier imputed
columns feed later ones.  Each written-back table is checkpointed to the
shared ``spark.checkpoint.dir`` so the lineage does not grow with the number
of columns and a lost executor does not replay earlier fits.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import Imputer, IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tabkiln.operators.models import spread
from tabkiln.operators.ordered import fill_forward_backward
from tabkiln.operators.project import _missing, _q, non_null_counts
from tabkiln.session import checkpoint_dir, write_shared


def _numeric(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def impute_partition(
    df: DataFrame, col: str, key: str, features: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Training rows and rows to predict for one column.

    train: ``col`` and the features used all set; to_predict: ``col`` missing,
    features filled forward then backward in key order, features with nothing
    to fill from dropped from both sides.  NaN is missing.  Returns ``(train[key, features, col], to_predict[key, features])``.
    """
    feats = list(features) if features is not None else [c for c in df.columns if c not in (key, col)]
    to_pred = df.filter(_missing(df, col)).select(key, *feats)
    to_pred = fill_forward_backward(to_pred, key, feats)
    counts = non_null_counts(to_pred, feats).first().asDict() if feats else {}
    keep = [f for f in feats if counts.get(f, 0) > 0]
    train = df.select(key, *keep, col).dropna(how="any", subset=[*keep, col])
    return train, to_pred.select(key, *keep)


def write_back(df: DataFrame, predictions: DataFrame, key: str, col: str, pred: str = "prediction") -> DataFrame:
    """Fill only the missing cells (NULL, NaN) of ``col`` with predictions joined by key."""
    p = predictions.select(key, F.col(pred).alias("_imputed"))
    joined = df.join(p, key, "left")
    dtype = df.schema[col].dataType
    return joined.withColumn(col, F.when(_missing(df, col), F.col("_imputed").cast(dtype)).otherwise(F.col(col))).drop("_imputed")


def _learner(kind: str, categorical: bool, seed: int, label: str, num_trees: int, max_depth: int, **params):
    if kind == "rf":
        cls = RandomForestClassifier if categorical else RandomForestRegressor
        return cls(featuresCol="_features", labelCol=label, numTrees=num_trees, maxDepth=max_depth, seed=seed, **params)
    if kind == "dt":
        cls = DecisionTreeClassifier if categorical else DecisionTreeRegressor
        return cls(featuresCol="_features", labelCol=label, maxDepth=max_depth, seed=seed, **params)
    raise ValueError("learner must be 'rf' or 'dt'")


def model_impute(
    df: DataFrame,
    cols: Sequence[str],
    key: str,
    learner: str = "rf",
    categorical: bool = False,
    features: Sequence[str] | None = None,
    num_trees: int = 20,
    max_depth: int = 8,
    seed: int = 10,
) -> DataFrame:
    """Impute ``cols`` one after another with a tree learner.

    ``categorical`` selects a classifier (labels indexed and mapped back);
    otherwise a regressor.  Features default to the numeric columns.  A column
    with missing cells raises where no feature is usable, or no row has it and
    the used features all set.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    cur = df
    for col in cols:
        feats = list(features) if features is not None else _numeric(cur, [key, col])
        feats = [f for f in feats if f != col]
        if cur.filter(_missing(cur, col)).isEmpty():
            continue
        train, to_pred = impute_partition(cur, col, key, feats)
        used = [c for c in to_pred.columns if c != key]
        if not used:
            raise ValueError(f"no usable feature to impute {col} from")
        if train.isEmpty():
            raise ValueError(f"no row has {col} and its features {used} all set")
        assembler = VectorAssembler(inputCols=used, outputCol="_features", handleInvalid="keep")
        if categorical:
            indexer = StringIndexer(inputCol=col, outputCol="_label", handleInvalid="keep")
            model_stage = _learner(learner, True, seed, "_label", num_trees, max_depth)
            fitted = Pipeline(stages=[indexer, assembler, model_stage]).fit(spread(train, key))
            labels = fitted.stages[0].labelsArray[0]
            scored = fitted.transform(to_pred)
            scored = IndexToString(inputCol="prediction", outputCol="_pred_label", labels=list(labels)).transform(scored)
            preds = scored.select(key, F.col("_pred_label").alias("prediction"))
        else:
            model_stage = _learner(learner, False, seed, col, num_trees, max_depth)
            fitted = Pipeline(stages=[assembler, model_stage]).fit(spread(train, key))
            preds = fitted.transform(to_pred).select(key, "prediction")
        cur = write_back(cur, preds, key, col).checkpoint(eager=True)
    return cur


# --------------------------------------------------------------------------
# fitted chains
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class ImputeStep:
    """How one column's missing cells are filled."""

    col: str
    means: dict  # feature -> what a missing cell of it counts as (its mean where the step was fitted)
    labels: list | None  # a classifier's labels as strings, by index; None: a regressor
    model: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the column filled; other columns as they are."""
        inputs = {_input(i): _filled(df, f, m) for i, (f, m) in enumerate(self.means.items())}
        scored = self.model.transform(df.withColumns(inputs))
        guess = F.col("prediction")
        if self.labels is not None:
            guess = F.get(F.array(*[F.lit(x) for x in self.labels]), guess.cast("int"))
        own = F.when(_missing(df, self.col), guess.cast(df.schema[self.col].dataType)).otherwise(_q(self.col))
        return scored.withColumn(self.col, own).select(*[_q(c) for c in df.columns])


@dataclass(frozen=True)
class ImputerChain:
    """Fitted steps; each reads the columns that the ones before it have filled."""

    steps: list

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill every step's column: one projection, no shuffle; a row's cells depend on that row alone."""
        for step in self.steps:
            df = step.transform(df)
        return df

    def save(self, spark: SparkSession, path: str) -> None:
        path = path.rstrip("/")
        for i, step in enumerate(self.steps):
            step.model.write().overwrite().save(f"{path}/model-{i}")
        facts = [(json.dumps([{"col": s.col, "means": s.means, "labels": s.labels} for s in self.steps]),)]
        spark.createDataFrame(facts, "value string").write.mode("overwrite").text(f"{path}/steps")


def load_imputer(spark: SparkSession, path: str) -> ImputerChain:
    path = path.rstrip("/")
    facts = json.loads(spark.read.text(f"{path}/steps").first()[0])
    return ImputerChain([ImputeStep(**f, model=PipelineModel.load(f"{path}/model-{i}")) for i, f in enumerate(facts)])


def _input(i: int) -> str:
    return f"_impute_{i}"


def _filled(df: DataFrame, feature: str, mean: float) -> Column:
    return F.when(_missing(df, feature), F.lit(float(mean))).otherwise(_q(feature).cast("double"))


def fit_imputer(
    df: DataFrame,
    cols: Sequence[str],
    learner: str = "rf",
    categorical: Sequence[str] = (),
    features: Sequence[str] | Mapping[str, Sequence[str]] | None = None,
    exclude: Sequence[str] = (),
    key: str | None = None,
    num_trees: int = 20,
    max_depth: int = 8,
    seed: int = 10,
    checkpoint_every: int = 5,
    **params,
) -> ImputerChain:
    """One model per column of ``cols``, in that order (I2-I5 as a fit).

    A column's model learns from the rows that have the column and all its
    features; a later column learns from cells that earlier steps have filled.
    Columns in ``categorical`` get a classifier, the others a regressor.
    Features default to the numeric columns outside ``exclude`` and may be named
    per column; a feature without a single value is not used.  Where a row to
    fill lacks a feature, the feature's mean in the fitted table stands in.
    Every column gets a model, whether it has gaps here or not.  The table is
    written to the shared folder after every ``checkpoint_every`` steps.
    """
    cur, steps = df, []
    for i, col in enumerate(cols):
        named = features.get(col) if isinstance(features, Mapping) else features
        feats = [f for f in (named if named is not None else _numeric(cur, exclude)) if f != col]
        stats = cur.agg(*[F.avg(F.when(~_missing(cur, f), _q(f)).cast("double")).alias(_input(j)) for j, f in enumerate(feats)]).first() if feats else []
        means = {f: m for f, m in zip(feats, stats) if m is not None}
        if not means:
            raise ValueError(f"no usable feature to impute {col} from")
        by = [key] if key is not None else []
        whole = cur.select(*by, *[_q(f).cast("double").alias(_input(j)) for j, f in enumerate(means)], _q(col).alias("_target"))
        whole = whole.dropna(how="any", subset=[c for c in whole.columns if c != key])
        # written: the check, the count and the layout read it, not the models of the steps before
        whole = write_shared(whole, "whole")
        if whole.isEmpty():
            raise ValueError(f"no row has {col} and its features {list(means)} all set")
        assembler = VectorAssembler(inputCols=[_input(j) for j in range(len(means))], outputCol="_features", handleInvalid="keep")
        rows, labels, target = spread(whole, key), None, "_target"
        if col in categorical:
            index = StringIndexer(inputCol="_target", outputCol="_label", handleInvalid="error").fit(rows)
            rows, labels, target = index.transform(rows), list(index.labelsArray[0]), "_label"
        else:
            rows = rows.withColumn("_target", F.col("_target").cast("double"))
        model = _learner(learner, col in categorical, seed, target, num_trees, max_depth, **params)
        steps.append(ImputeStep(col, means, labels, Pipeline(stages=[assembler, model]).fit(rows)))
        cur = steps[-1].transform(cur)
        if (i + 1) % checkpoint_every == 0 and i + 1 < len(cols):
            cur = write_shared(cur, "imputed")
    return ImputerChain(steps)


def simple_impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean") -> DataFrame:
    """Mean / median / mode imputation of numeric columns with ``ml.feature.Imputer``."""
    imp = Imputer(inputCols=list(cols), outputCols=list(cols), strategy=strategy)
    return imp.fit(df).transform(df)
