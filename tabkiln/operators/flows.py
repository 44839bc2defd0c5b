"""From a raw table to collated predictions: cleaning, then training and scoring (M8).

The cleaning is fitted once (NULL shares, means or imputing models, collinear
columns, ranges) and saved with the models, so a table scored later goes through
the same projection, row by row.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.operators.impute import ImputerChain, fit_imputer, load_imputer
from tabkiln.operators.models import CvResult, fit_and_predict, fit_only, predict_only
from tabkiln.operators.profile import fit_collinear, fit_stats, numeric_columns, rejected_columns
from tabkiln.operators.project import _missing
from tabkiln.operators.scale import MinMaxModel, fit_minmax
from tabkiln.operators.split import holdout_split
from tabkiln.session import write_shared


@dataclass(frozen=True)
class Cleaning:
    """Fitted cleaning steps; ``transform`` drops, fills and scales in that order."""

    key: str
    rejected: list
    imputer: str  # 'mean', or a learner of fit_imputer
    means: dict
    collinear: list
    stats: dict
    ranges: dict
    chain: ImputerChain | None = None  # the learner's fitted models

    def fill(self, df: DataFrame) -> DataFrame:
        """Numeric features without missing cells; non-numeric columns stay as they are."""
        df = df.drop(*self.rejected)
        if self.imputer == "mean":
            return df.withColumns(
                {c: F.when(_missing(df, c), F.lit(m)).otherwise(F.col(c).cast("double")) for c, m in self.means.items()}
            )
        return self.chain.transform(df)

    def transform(self, df: DataFrame) -> DataFrame:
        return self._scaled(self.fill(df))

    def _scaled(self, filled: DataFrame) -> DataFrame:
        return MinMaxModel(self.stats, self.ranges).transform(filled.drop(*self.collinear))

    @property
    def features(self) -> list[str]:
        return list(self.stats)

    def save(self, spark: SparkSession, path: str) -> None:
        facts = asdict(replace(self, chain=None))
        spark.createDataFrame([(json.dumps(facts),)], "value string").write.mode("overwrite").text(path)
        if self.chain is not None:
            self.chain.save(spark, f"{path}-imputer")


def load_cleaning(spark: SparkSession, path: str) -> Cleaning:
    cleaning = Cleaning(**json.loads(spark.read.text(path).first()[0]))
    return cleaning if cleaning.imputer == "mean" else replace(cleaning, chain=load_imputer(spark, f"{path}-imputer"))


def fit_cleaning(
    df: DataFrame,
    key: str,
    target: str,
    null_threshold: float = 0.4,
    imputer: str = "mean",
    collinear_threshold: float = 0.95,
    feature_range: tuple[float, float] = (0.0, 10.0),
) -> Cleaning:
    """Columns mostly NULL are rejected, the rest filled, collinear ones dropped, the others scaled.

    ``imputer`` is 'mean', or the learner ('rf', 'dt') of a chain of models fitted here and only applied later.
    """
    rejected = [c for c in rejected_columns(df, null_threshold) if c not in (key, target)]
    feats = numeric_columns(df, [key, target, *rejected])
    means = {c: s["mean"] for c, s in fit_stats(df, feats).items()}
    chain = None if imputer == "mean" else fit_imputer(df.drop(*rejected), feats, imputer, features=feats, key=key)
    draft = Cleaning(key, rejected, imputer, means, [], {}, {}, chain)
    filled = draft.fill(df)
    if chain is not None and feats:  # written, so that the models fill each row once for all passes below
        filled = write_shared(filled.select(*feats), "filled")
    collinear = fit_collinear(filled, feats, collinear_threshold) if len(feats) > 1 else []
    kept = [c for c in feats if c not in collinear]
    scaler = fit_minmax(filled, kept, feature_range)
    return Cleaning(key, rejected, imputer, means, collinear, scaler.stats, scaler.ranges, chain)


def train_test(
    df: DataFrame,
    key: str,
    target: str,
    learners: Mapping[str, Mapping] | Sequence[str] = ("gbt", "rf"),
    test_fraction: float = 0.2,
    n_folds: int = 2,
    tolerance: float = 3.0,
    seed: int | str = 120,
    cleaned_path: str | None = None,
    **cleaning,
) -> tuple[DataFrame, dict[str, CvResult]]:
    """Clean, split, train by k folds per learner and collate the test predictions with the truth.

    ``cleaned_path`` also saves the cleaned table, which the split then reads.
    """
    cleaner = fit_cleaning(df, key, target, **cleaning)
    cleaned = cleaner.transform(df)
    if cleaned_path is not None:
        cleaned.write.mode("overwrite").parquet(cleaned_path)
        cleaned = df.sparkSession.read.parquet(cleaned_path)
    tagged = holdout_split(cleaned, key, test_fraction, seed)
    train, test = (tagged.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    return fit_and_predict(train, test, key, target, learners, n_folds, tolerance, cleaner.features)


def train_only(
    df: DataFrame,
    key: str,
    target: str,
    model_dir: str,
    learners: Mapping[str, Mapping] | Sequence[str] = ("gbt", "rf"),
    n_folds: int = 2,
    **cleaning,
) -> dict[str, str]:
    """Clean, train on every row and save the cleaning and the models under ``model_dir``; returns model paths."""
    cleaner = fit_cleaning(df, key, target, **cleaning)
    cleaner.save(df.sparkSession, f"{model_dir.rstrip('/')}/cleaning")
    return fit_only(cleaner.transform(df), key, target, model_dir, learners, n_folds, cleaner.features)


def predict(df: DataFrame, model_dir: str, model_paths: Mapping[str, str]) -> DataFrame:
    """Scores of a raw table: the saved cleaning, then the saved models and their ensembles."""
    cleaner = load_cleaning(df.sparkSession, f"{model_dir.rstrip('/')}/cleaning")
    return predict_only(cleaner.transform(df), cleaner.key, model_paths)
