"""Queries for collation, ensembles and tolerance accuracy (step 1 of the plan)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.operators import ensemble
from tabkiln.plans import fixtures as fx
from tabkiln.plans.registry import register
from tabkiln.session import checkpoint_dir
from tabkiln.sources import read_csv, write_bucketed, write_csv

_MODELS = ("a", "b", "comb_max", "comb_min", "comb_mean", "comb_median")
_COLLATE_DOUBLES = ["y"] + [c for m in _MODELS for c in (f"y_pred_{m}", f"y_pred_{m}_abs_err")]

_BASE = ",\n".join([fx.TRUTH_SQL, fx.PRED_A_SQL.format(where=""), fx.PRED_B_SQL.format(where="")])

_COLLATE_SQL = f"""WITH {_BASE},
j AS (
  SELECT t.id, t.y, a.y_pred_a, b.y_pred_b FROM truth t
  JOIN pred_a a ON a.id = t.id JOIN pred_b b ON b.id = t.id),
m AS (
  SELECT id, median(v) AS y_pred_comb_median
  FROM (SELECT id, y_pred_a AS v FROM j UNION ALL SELECT id, y_pred_b FROM j) GROUP BY id),
e AS (
  SELECT j.id, j.y, y_pred_a, y_pred_b,
         greatest(y_pred_a, y_pred_b) AS y_pred_comb_max,
         least(y_pred_a, y_pred_b) AS y_pred_comb_min,
         (y_pred_a + y_pred_b) / 2.0 AS y_pred_comb_mean,
         m.y_pred_comb_median
  FROM j JOIN m ON m.id = j.id)
SELECT id, y,
  {", ".join(f"y_pred_{m}, abs(y_pred_{m} - y) AS y_pred_{m}_abs_err, CASE WHEN abs(y_pred_{m} - y) > 3.0 THEN 0 ELSE 1 END AS result_{m}" for m in _MODELS)}
FROM e"""


def _collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ensemble.collate(
        [fx.pred_a(spark, sf_dir), fx.pred_b(spark, sf_dir)], fx.truth(spark, sf_dir), tolerance=3.0
    )


@register("ensemble_collate", _COLLATE_SQL, doubles=_COLLATE_DOUBLES)
def ensemble_collate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models, truth, ensembles, errors and flags."""
    return _collated(spark, sf_dir)


_ACC_SQL = f"""WITH c AS ({_COLLATE_SQL})
SELECT * FROM (UNPIVOT (SELECT {", ".join(f"avg(CAST(result_{m} AS DOUBLE)) AS result_{m}" for m in _MODELS)} FROM c)
  ON {", ".join(f"result_{m}" for m in _MODELS)} INTO NAME result VALUE accuracy)"""


@register("ensemble_accuracy", _ACC_SQL, doubles=["accuracy"])
def ensemble_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tolerance accuracy per model and ensemble."""
    return ensemble.tolerance_accuracy(_collated(spark, sf_dir))


_COUNTS_SQL = f"""WITH c AS ({_COLLATE_SQL}),
u AS (UNPIVOT (SELECT {", ".join(f"result_{m}" for m in _MODELS)} FROM c)
      ON {", ".join(f"result_{m}" for m in _MODELS)} INTO NAME result VALUE value)
SELECT result, CAST(value AS INTEGER) AS value, count(*) AS n FROM u GROUP BY result, value"""


@register("result_value_counts", _COUNTS_SQL)
def result_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of correct/incorrect rows per model."""
    return ensemble.result_value_counts(_collated(spark, sf_dir))


_PRETRAINED_SQL = f"""WITH {_BASE},
j AS (
  SELECT t.id, a.y_pred_a, b.y_pred_b FROM truth t
  JOIN pred_a a ON a.id = t.id JOIN pred_b b ON b.id = t.id)
SELECT id, y_pred_a, y_pred_b,
       greatest(y_pred_a, y_pred_b) AS y_pred_comb_max,
       least(y_pred_a, y_pred_b) AS y_pred_comb_min,
       (y_pred_a + y_pred_b) / 2.0 AS y_pred_comb_mean,
       (y_pred_a + y_pred_b) / 2.0 AS y_pred_comb_median
FROM j"""


@register(
    "ensemble_pretrained",
    _PRETRAINED_SQL,
    doubles=["y_pred_a", "y_pred_b", "y_pred_comb_max", "y_pred_comb_min", "y_pred_comb_mean", "y_pred_comb_median"],
)
def ensemble_pretrained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: ensembles without truth, restricted to the ids of the main table."""
    return ensemble.collate_pretrained(
        [fx.pred_a(spark, sf_dir), fx.pred_b(spark, sf_dir)], fx.truth(spark, sf_dir).select("id")
    )


_OUTER_SQL = f"""WITH {fx.PRED_A_SQL.format(where=" WHERE o_orderkey % 10 <> 0")},
{fx.PRED_B_SQL.format(where=" WHERE o_orderkey % 15 <> 0")}
SELECT coalesce(a.id, b.id) AS id, a.y_pred_a, b.y_pred_b
FROM pred_a a FULL OUTER JOIN pred_b b ON a.id = b.id"""


@register("predictions_full_outer", _OUTER_SQL, doubles=["y_pred_a", "y_pred_b"])
def predictions_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full outer alignment of prediction tables with missing keys on both sides."""
    return ensemble.align_predictions([fx.pred_a(spark, sf_dir, 10), fx.pred_b(spark, sf_dir, 15)])


_OUTER_COLLATE_SQL = f"""WITH {fx.TRUTH_SQL},
{fx.PRED_A_SQL.format(where=" WHERE o_orderkey % 10 <> 0")},
{fx.PRED_B_SQL.format(where=" WHERE o_orderkey % 15 <> 0")},
p AS (SELECT coalesce(a.id, b.id) AS id, a.y_pred_a, b.y_pred_b
      FROM pred_a a FULL OUTER JOIN pred_b b ON a.id = b.id),
j AS (SELECT p.id, t.y, p.y_pred_a, p.y_pred_b FROM truth t JOIN p ON p.id = t.id),
m AS (SELECT id, median(v) AS med FROM (
        SELECT id, y_pred_a AS v FROM j UNION ALL SELECT id, y_pred_b FROM j) GROUP BY id)
SELECT j.id, j.y,
       greatest(y_pred_a, y_pred_b) AS y_pred_comb_max,
       least(y_pred_a, y_pred_b) AS y_pred_comb_min,
       (coalesce(y_pred_a, 0) + coalesce(y_pred_b, 0))
         / ((y_pred_a IS NOT NULL)::INT + (y_pred_b IS NOT NULL)::INT) AS y_pred_comb_mean,
       m.med AS y_pred_comb_median,
       CASE WHEN abs(m.med - j.y) > 3.0 THEN 0 ELSE 1 END AS result_comb_median,
       CASE WHEN abs(y_pred_a - j.y) > 3.0 THEN 0 ELSE 1 END AS result_a
FROM j JOIN m ON m.id = j.id"""


@register(
    "ensemble_partial_predictions",
    _OUTER_COLLATE_SQL,
    doubles=["y", "y_pred_comb_max", "y_pred_comb_min", "y_pred_comb_mean", "y_pred_comb_median"],
)
def ensemble_partial_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 when models miss keys: ensembles skip missing predictions, a missing error counts as correct."""
    c = ensemble.collate(
        [fx.pred_a(spark, sf_dir, 10), fx.pred_b(spark, sf_dir, 15)], fx.truth(spark, sf_dir), tolerance=3.0
    )
    return c.select(
        "id", "y", "y_pred_comb_max", "y_pred_comb_min", "y_pred_comb_mean", "y_pred_comb_median",
        "result_comb_median", "result_a",
    )


@register("csv_roundtrip", _COLLATE_SQL, doubles=_COLLATE_DOUBLES)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collated table written as header CSV to the shared folder and read back."""
    collated = _collated(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-roundtrip-{uuid.uuid4().hex}"
    write_csv(collated, path)
    back = read_csv(spark, path, schema=collated.schema)
    return back.select(*[F.col(c) for c in collated.columns])


@register("ensemble_two_model", _COLLATE_SQL, doubles=_COLLATE_DOUBLES)
def ensemble_two_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: the legacy two-model entry point, served by the general collation."""
    return ensemble.collate_two(fx.pred_a(spark, sf_dir), fx.pred_b(spark, sf_dir), fx.truth(spark, sf_dir), 3.0)


@register("collate_bucketed", _COLLATE_SQL, doubles=_COLLATE_DOUBLES)
def collate_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both predictions and the truth stored in buckets of the key, then collated without a shuffle."""
    run = uuid.uuid4().hex
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tables"
    tables = {"truth": fx.truth(spark, sf_dir), "pred_a": fx.pred_a(spark, sf_dir), "pred_b": fx.pred_b(spark, sf_dir)}
    stored = {n: write_bucketed(df, f"{n}_{run}", f"{folder}/{n}-{run}", "id", 16) for n, df in tables.items()}
    truth = stored.pop("truth")
    return ensemble.collate_bucketed(stored, truth, tolerance=3.0)
