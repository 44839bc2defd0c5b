"""Gradient boosting of regression trees with patience and a best round.

MLlib's boosting stops at the first round that gains too little.  Here every
round fits one MLlib tree to the residuals of the rounds before, scores the
training and the validation rows in one aggregate, and goes on until no round
of the last ``patience`` was better than the best one; the ensemble is then cut
back to that round.

The predictions so far are a column.  A round adds one projection to it; after
``checkpoint_every`` rounds the table is written to the shared folder, so the
plan stays short and a lost executor replays few rounds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import SparkContext, StorageLevel
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.session import write_shared

_PRED, _STEP, _VALID = "_boosted", "_boosted_step", "_boosted_valid"


@dataclass(frozen=True)
class Boosted:
    """A boosted model, cut back to its best round."""

    model: GBTRegressionModel
    best_round: int  # trees after the constant one
    history: list  # (round, train RMSE, validation RMSE), the constant being round 0


def ensemble(trees: list, weights: list[float], n_features: int) -> GBTRegressionModel:
    """The weighted sum of fitted regression trees as one MLlib model, to transform, inspect and save like any other."""
    gateway = SparkContext.getOrCreate()._gateway
    package = gateway.jvm.org.apache.spark.ml.regression
    members = gateway.new_array(package.DecisionTreeRegressionModel, len(trees))
    shares = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        members[i], shares[i] = tree._java_obj, float(weight)
    built = package.GBTRegressionModel(f"boosted_{trees[-1].uid}", members, shares, n_features)
    model = GBTRegressionModel._from_java(built)
    return model.setFeaturesCol(trees[0].getFeaturesCol())


def _errors(scored: DataFrame, label: str) -> tuple[float | None, float | None]:
    """RMSE over the training and over the validation rows, NULL where there are none."""
    err2 = F.pow(F.col(_PRED) - F.col(label), 2)
    row = scored.agg(
        F.sqrt(F.avg(F.when(~F.col(_VALID), err2))).alias("train"), F.sqrt(F.avg(F.when(F.col(_VALID), err2))).alias("valid")
    ).first()
    return row["train"], row["valid"]


def fit_boosted(
    table: DataFrame,
    valid: Column,
    features: str = "_features",
    label: str = "_label",
    rounds: int = 50,
    patience: int | None = 10,
    step: float = 0.1,
    checkpoint_every: int = 10,
    seed: int = 50,
    **tree,
) -> Boosted:
    """Boost on the rows of ``table`` outside ``valid`` for at most ``rounds`` rounds.

    A round counts as better if its validation RMSE is below the best one so
    far.  Without validation rows, or with ``patience`` None, every round is
    run; the best round is then the last one, or the best seen.  ``tree`` are
    parameters of ``DecisionTreeRegressor``.  Rows without a label must be
    dropped before.
    """
    est = DecisionTreeRegressor(featuresCol=features, labelCol=_STEP, seed=seed, **tree)
    state = table.withColumn(_VALID, valid)
    train = state.filter(~F.col(_VALID))
    root = est.copy({est.maxDepth: 0}).fit(train.withColumn(_STEP, F.col(label).cast("double")))
    constant = float(root._java_obj.rootNode().prediction())
    scored = state.withColumn(_PRED, F.lit(constant))
    trees, history = [root], [(0, *_errors(scored, label))]
    best = 0
    held: DataFrame | None = None
    try:
        for r in range(1, rounds + 1):
            residual = scored.filter(~F.col(_VALID)).withColumn(_STEP, F.col(label) - F.col(_PRED))
            fitted = est.fit(residual)
            trees.append(fitted)
            scored = (
                fitted.transform(scored, {fitted.predictionCol: _STEP})
                .withColumn(_PRED, F.col(_PRED) + F.lit(float(step)) * F.col(_STEP))
                .drop(_STEP)
            )
            history.append((r, *_errors(scored, label)))
            if history[-1][2] is None or history[best][2] is None or history[-1][2] < history[best][2]:
                best = r
            elif patience is not None and r - best >= patience:
                break
            if r % checkpoint_every == 0 and r < rounds:
                old, held = held, write_shared(scored, "boosting").persist(StorageLevel.MEMORY_AND_DISK)
                scored = held
                if old is not None:
                    old.unpersist()
    finally:
        if held is not None:
            held.unpersist()
    kept = trees[: best + 1]
    return Boosted(ensemble(kept, [1.0] + [step] * best, root.numFeatures), best, history)
