"""Queries for binary metrics, threshold tuning and reports (step 5).

The oracles compute the threshold sweep by brute force (every grid point
against every row), an independent algorithm from the histogram sweep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.operators import metrics, ordered, selection
from tabkiln.plans import fixtures as fx
from tabkiln.plans.registry import register

_RATES = ["accuracy", "precision", "recall", "f1"]


def grid_values_sql(grid) -> str:
    return "(VALUES " + ", ".join(f"({i}, '{g!r}'::DOUBLE)" for i, g in enumerate(grid)) + ") AS grid(t, threshold)"


def _counts_sql(pred: str, label: str) -> str:
    return (
        f"CAST(sum(CASE WHEN {pred} = 1 AND {label} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp, "
        f"CAST(sum(CASE WHEN {pred} = 1 AND {label} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
        f"CAST(sum(CASE WHEN {pred} = 0 AND {label} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn, "
        f"CAST(sum(CASE WHEN {pred} = 0 AND {label} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn"
    )


RATES_SQL = (
    "CASE WHEN tp + fp + tn + fn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + tn + fn) END AS accuracy, "
    "CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision, "
    "CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall, "
    "CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1"
)

_BIN_SQL = f"""WITH {fx.TEXT_SQL},
c AS (SELECT {_counts_sql("CASE WHEN prob > 0.5 THEN 1 ELSE 0 END", "labels")}, count(*) AS num_samples FROM text_fx)
SELECT *, {RATES_SQL} FROM c"""


@register("binary_metrics", _BIN_SQL, doubles=_RATES)
def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion counts and rates at prob > 0.5."""
    return metrics.binary_metrics(fx.text(spark, sf_dir), "prob", "labels", 0.5)


_BIN_CAT_SQL = f"""WITH {fx.TEXT_SQL},
c AS (SELECT id_aux, {_counts_sql("CASE WHEN prob > 0.5 THEN 1 ELSE 0 END", "labels")}, count(*) AS num_samples
      FROM text_fx GROUP BY id_aux)
SELECT *, {RATES_SQL} FROM c"""


@register("binary_metrics_by_category", _BIN_CAT_SQL, doubles=_RATES)
def binary_metrics_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per category, without a loop over categories."""
    return metrics.binary_metrics(fx.text(spark, sf_dir), "prob", "labels", 0.5, by=["id_aux"])


_SWEEP_CTE = f"""sweep AS (
  SELECT id_aux, grid.t, grid.threshold,
         {_counts_sql("CASE WHEN prob > grid.threshold THEN 1 ELSE 0 END", "labels")}
  FROM text_fx, {grid_values_sql(metrics.CATEGORY_GRID)}
  GROUP BY id_aux, grid.t, grid.threshold),
sweep_f1 AS (
  SELECT *, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM sweep),
best AS (
  SELECT id_aux, threshold, f1 FROM (
    SELECT *, row_number() OVER (PARTITION BY id_aux ORDER BY f1 DESC, t ASC) AS rn FROM sweep_f1) WHERE rn = 1)"""

_SWEEP_SQL = f"""WITH {fx.TEXT_SQL}, {_SWEEP_CTE}
SELECT id_aux, threshold, tp, fp, fn, tn, f1 FROM sweep_f1"""


@register("threshold_sweep", _SWEEP_SQL, doubles=["threshold", "f1"])
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and F1 at each of the 99 grid thresholds per category, from one histogram."""
    return metrics.threshold_sweep(fx.text(spark, sf_dir), "prob", "labels", ["id_aux"], metrics.CATEGORY_GRID)


_TUNE_SQL = f"""WITH {fx.TEXT_SQL}, {_SWEEP_CTE}
SELECT id_aux, threshold, f1 FROM best"""


@register("category_threshold_tuning", _TUNE_SQL, doubles=["threshold", "f1"])
def category_threshold_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-F1 threshold per category on linspace(0.01, 0.99, 99), ties to the smallest."""
    return metrics.tune_thresholds(fx.text(spark, sf_dir), "prob", "labels", ["id_aux"], metrics.CATEGORY_GRID)


_REPORT_SQL = f"""WITH {fx.TEXT_SQL}, {_SWEEP_CTE},
s AS (SELECT t.*, CASE WHEN t.prob > b.threshold THEN 1 ELSE 0 END AS pred, b.threshold AS optimal_threshold
      FROM text_fx t JOIN best b ON t.id_aux = b.id_aux),
c AS (SELECT id_aux, any_value(optimal_threshold) AS optimal_threshold, count(*) AS num_samples,
             {_counts_sql("pred", "labels")} FROM s GROUP BY id_aux),
r AS (SELECT *, {RATES_SQL} FROM c)
SELECT id_aux, num_samples, optimal_threshold, f1 AS f1_optimized, accuracy AS accuracy_optimized,
       precision AS precision_optimized, recall AS recall_optimized FROM r"""


@register(
    "category_report",
    _REPORT_SQL,
    doubles=["optimal_threshold", "f1_optimized", "accuracy_optimized", "precision_optimized", "recall_optimized"],
)
def category_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-category samples, tuned threshold and metrics at it, sorted by category."""
    return metrics.category_report(fx.text(spark, sf_dir), "prob", "labels", "id_aux")


_OVERALL_CTE = f"""s AS (SELECT t.*, CASE WHEN t.prob > b.threshold THEN 1 ELSE 0 END AS pred_opt,
             CASE WHEN t.prob > 0.5 THEN 1 ELSE 0 END AS pred_fixed
      FROM text_fx t JOIN best b ON t.id_aux = b.id_aux),
c AS (SELECT 'at_0.5' AS threshold_mode, {_counts_sql("pred_fixed", "labels")} FROM s
      UNION ALL
      SELECT 'optimized', {_counts_sql("pred_opt", "labels")} FROM s),
overall AS (SELECT *, {RATES_SQL} FROM c)"""

_OVERALL_SQL = f"""WITH {fx.TEXT_SQL}, {_SWEEP_CTE}, {_OVERALL_CTE}
SELECT * FROM overall"""


@register("tuned_overall_metrics", _OVERALL_SQL, doubles=_RATES)
def tuned_overall_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overall metrics at 0.5 and with the per-category tuned thresholds."""
    return metrics.overall_metrics(fx.text(spark, sf_dir), "prob", "labels", "id_aux")


_LONG_SQL = f"""WITH {fx.TEXT_SQL}, {_SWEEP_CTE}, {_OVERALL_CTE},
u AS (UNPIVOT (SELECT threshold_mode, CAST(accuracy AS DOUBLE) AS accuracy, CAST(f1 AS DOUBLE) AS f1,
                      CAST(precision AS DOUBLE) AS precision, CAST(recall AS DOUBLE) AS recall,
                      CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tn AS DOUBLE) AS tn,
                      CAST(fn AS DOUBLE) AS fn FROM overall)
      ON accuracy, f1, precision, recall, tp, fp, tn, fn INTO NAME metric VALUE value)
SELECT 'overall_' || metric || '_' || threshold_mode AS name, value FROM u"""


@register("metrics_long", _LONG_SQL, doubles=["value"])
def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat metric names ``overall_<metric>_at_0.5`` / ``_optimized`` with values."""
    return metrics.metrics_long(metrics.overall_metrics(fx.text(spark, sf_dir), "prob", "labels", "id_aux"))


_FOLD_SQL = f"""WITH {fx.TRUTH_SQL}, {fx.PRED_A_SQL.format(where="")},
j AS (SELECT t.id, t.y, a.y_pred_a, CAST(ntile(3) OVER (ORDER BY t.id) - 1 AS VARCHAR) AS fold
      FROM truth t JOIN pred_a a ON a.id = t.id),
u AS (SELECT fold, y, y_pred_a FROM j UNION ALL SELECT 'overall', y, y_pred_a FROM j)
SELECT fold, count(*) AS n, sqrt(avg(pow(y_pred_a - y, 2))) AS rmse,
       1.0 - sum(pow(y_pred_a - y, 2)) / nullif(count(*) * var_pop(y), 0) AS r2
FROM u GROUP BY fold"""


@register("fold_metrics", _FOLD_SQL, doubles=["rmse", "r2"])
def fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RMSE and R^2 per contiguous fold and overall."""
    j = fx.truth(spark, sf_dir).join(fx.pred_a(spark, sf_dir), "id")
    folded = ordered.assign_folds(j, "id", 3).withColumn("fold", F.col("fold").cast("string"))
    return metrics.regression_metrics(folded, "y_pred_a", "y", by=["fold"], with_total="overall")


@register(
    "median_by_priority",
    "SELECT o_orderpriority, count(o_totalprice) AS n, median(o_totalprice)::DOUBLE AS median FROM orders GROUP BY o_orderpriority",
    doubles=["median"],
)
def median_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians of a few large groups by histogram refinement."""
    return selection.group_median(fx.t(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice")


_LONG_MEDIAN_SQL = """SELECT l_orderkey, count(*) AS n, median(l_extendedprice)::DOUBLE AS median FROM lineitem GROUP BY l_orderkey"""


@register("median_long_predictions", _LONG_MEDIAN_SQL, doubles=["median"])
def median_long_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians by id over long rows, many small groups."""
    return selection.group_median(fx.t(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_extendedprice")
