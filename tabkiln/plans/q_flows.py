"""Queries with exact answers for learners, flows and rows that are easy to lose.

One-feature linear regression has a closed form that SQL can give
(``regr_slope``, ``regr_intercept``), so folds, averaging, persistence and the
cleaning before them are held to it exactly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.operators import flows, models, ordered, profile, reduce, split
from tabkiln.plans import fixtures as fx
from tabkiln.plans.registry import register
from tabkiln.session import checkpoint_dir


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _lr_cte(source: str, x: str) -> str:
    """Closed form of two contiguous folds on the training side of a 20 % hold-out of ``source``."""
    return f"""tagged AS (
  SELECT id, y, {x} AS x, row_number() OVER (ORDER BY md5('120:' || CAST(id AS VARCHAR)), id)
           <= ceil(count(*) OVER () * 0.2) AS test FROM {source}),
folds AS (SELECT id, y, x, ntile(2) OVER (ORDER BY id) - 1 AS fold FROM tagged WHERE NOT test),
fits AS (SELECT k, regr_slope(y, x) AS slope, regr_intercept(y, x) AS icept
         FROM folds, (VALUES (0), (1)) v(k) WHERE fold <> k GROUP BY k)"""


def _reg_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tagged = split.holdout_split(fx.reg(spark, sf_dir).select("id", "y", "x1"), "id", 0.2, seed=120)
    return tagged.filter("split = 'train'").drop("split"), tagged.filter("split = 'test'").drop("split")


_CV_LR_SQL = f"""WITH {fx.REG_SQL}, {_lr_cte("reg", "x1")}
SELECT t.id, avg(f.slope * t.x + f.icept) AS y_pred_lr FROM tagged t, fits f WHERE t.test GROUP BY t.id"""


@register("cv_regression_lr", _CV_LR_SQL, doubles=["y_pred_lr"])
def cv_regression_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: test predictions of two folds' linear models, averaged on one scan of the test table."""
    train, test = _reg_split(spark, sf_dir)
    return models.cv_regression(train, test, "id", "y", ["x1"], "lr", 2).predictions


_OOF_LR_SQL = f"""WITH {fx.REG_SQL}, {_lr_cte("reg", "x1")}
SELECT o.id, f.slope * o.x + f.icept AS y_pred_lr FROM folds o JOIN fits f ON f.k = o.fold"""


@register("cv_out_of_fold_lr", _OOF_LR_SQL, doubles=["y_pred_lr"])
def cv_out_of_fold_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each training row scored by the model that has not seen its fold."""
    train, _ = _reg_split(spark, sf_dir)
    return models.cv_regression(train, None, "id", "y", ["x1"], "lr", 2).oof


_METRICS_LR_SQL = f"""WITH {fx.REG_SQL}, {_lr_cte("reg", "x1")},
e AS (SELECT f.k, o.fold, o.y, f.slope * o.x + f.icept AS p FROM folds o, fits f),
per AS (SELECT k, sqrt(avg((y - p) * (y - p)) FILTER (fold <> k)) AS train,
               sqrt(avg((y - p) * (y - p)) FILTER (fold = k)) AS valid FROM e GROUP BY k)
SELECT CAST(k AS VARCHAR) AS fold, train, valid, CAST(NULL AS INTEGER) AS n_trees FROM per
UNION ALL
SELECT 'overall', (SELECT avg(train) FROM per), 1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), NULL
FROM e WHERE fold = k"""


@register("cv_metrics_lr", _METRICS_LR_SQL, doubles=["train", "valid"])
def cv_metrics_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and valid RMSE per fold, mean train RMSE and out-of-fold R^2."""
    train, _ = _reg_split(spark, sf_dir)
    return models.cv_regression(train, None, "id", "y", ["x1"], "lr", 2).metrics


_LOAD_LR_SQL = f"""WITH {fx.REG_SQL}, {_lr_cte("reg", "x1")}
SELECT t.id, f.slope * t.x + f.icept AS y_pred_lr FROM tagged t JOIN fits f ON f.k = 1 WHERE t.test"""


@register("load_predict_lr", _LOAD_LR_SQL, doubles=["y_pred_lr"])
def load_predict_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last fold's model, saved, reloaded and applied to the test table."""
    train, test = _reg_split(spark, sf_dir)
    paths = models.fit_only(train, "id", "y", _folder(spark, "models"), {"lr": {}}, 2, ["x1"])
    return models.score_saved(test, paths, "id")["lr"]


# raw table: m1 a quarter NULL, m2 a multiple of m1, n2 mostly NULL; m1 alone survives the cleaning
_RAW_SQL = f"""{fx.REG_SQL},
raw AS (SELECT id, y, CASE WHEN id % 4 <> 0 THEN x1 END AS m1 FROM reg),
clean AS (SELECT id, y, (m - min(m) OVER ()) / (max(m) OVER () - min(m) OVER ()) * 10 AS m1
          FROM (SELECT id, y, coalesce(m1, avg(m1) OVER ()) AS m FROM raw))"""


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    m1 = F.when(F.col("id") % 4 != 0, F.col("x1"))
    return fx.reg(spark, sf_dir).select("id", "y", m1.alias("m1"), (m1 * 1.01).alias("m2"), "n2")


_FLOW_SQL = f"""WITH {_RAW_SQL}, {_lr_cte("clean", "m1")},
p AS (SELECT t.id, any_value(t.y) AS y, avg(f.slope * t.x + f.icept) AS y_pred_lr
      FROM tagged t, fits f WHERE t.test GROUP BY t.id)
SELECT id, y, y_pred_lr, CASE WHEN abs(y - y_pred_lr) > 3.0 THEN 0 ELSE 1 END AS result_lr FROM p"""


@register("pipeline_train_test", _FLOW_SQL, doubles=["y", "y_pred_lr"])
def pipeline_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: NULL profile, mean fill, collinear drop, scaling, split, two folds, collation with the truth."""
    out, _ = flows.train_test(_raw(spark, sf_dir), "id", "y", {"lr": {}}, cleaned_path=_folder(spark, "cleaned"))
    return out.select("id", "y", "y_pred_lr", "result_lr")


_PREDICT_SQL = f"""WITH {_RAW_SQL},
folds AS (SELECT id, y, m1, ntile(2) OVER (ORDER BY id) - 1 AS fold FROM clean),
f AS (SELECT regr_slope(y, m1) AS slope, regr_intercept(y, m1) AS icept FROM folds WHERE fold <> 1)
SELECT id, slope * m1 + icept AS y_pred_lr FROM clean, f"""


@register("pipeline_train_predict", _PREDICT_SQL, doubles=["y_pred_lr"])
def pipeline_train_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8/M3: train-only saves cleaning and model; predict-only reuses both on the raw table."""
    raw, folder = _raw(spark, sf_dir), _folder(spark, "flow")
    paths = flows.train_only(raw, "id", "y", folder, {"lr": {}})
    return flows.predict(raw.drop("y"), folder, paths).select("id", "y_pred_lr")


@register("pipeline_forest_facts", "SELECT count(*) AS n_rows, 0::BIGINT AS n_null, true AS beats_mean FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS i, count(*) OVER () AS n FROM orders) WHERE i <= ceil(n * 0.2)")
def pipeline_forest_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flow with tree imputation and a forest: row count, NULLs, better than the mean predictor."""
    out, _ = flows.train_test(
        _raw(spark, sf_dir).select("id", "y", "m1", (F.col("id") % 7).cast("double").alias("w")), "id", "y",
        {"rf": {"numTrees": 10, "maxDepth": 6}}, imputer="dt",
    )
    err = F.avg(F.pow(F.col("y") - F.col("y_pred_rf"), 2))
    return out.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("y_pred_rf").isNull(), 1)).alias("n_null"),
        (err < F.var_pop("y")).alias("beats_mean"),
    )


_PCA_COLS = ["x1", "x3"]
# l1 - a without the cancellation: (l1 - a) * (l1 - d) = b * b
_PCA_SQL = f"""WITH {fx.REG_SQL},
c AS (SELECT avg(x1) AS ma, avg(x3) AS mb, var_samp(x1) AS a, var_samp(x3) AS d, covar_samp(x1, x3) AS b FROM reg),
l AS (SELECT *, (a + d) / 2 + sqrt(power((a - d) / 2, 2) + b * b) AS l1 FROM c),
g AS (SELECT *, CASE WHEN a > d THEN b * b / (l1 - d) ELSE l1 - a END AS g FROM l),
v AS (SELECT *, sqrt(b * b + g * g) AS len FROM g)
SELECT id, abs(((x1 - ma) * b + (x3 - mb) * g) / len) AS pca_0,
       abs(((x1 - ma) * g - (x3 - mb) * b) / len) AS pca_1,
       l1 / (a + d) AS explained_0
FROM reg, v"""


@register("pca_two_columns", _PCA_SQL, doubles=["pca_0", "pca_1", "explained_0"])
def pca_two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: both components (signs apart) and the explained share against the closed form of a 2x2 covariance."""
    out, explained = reduce.pca_features(fx.reg(spark, sf_dir), _PCA_COLS, 2, keep=["id"])
    return out.select("id", F.abs("pca_0").alias("pca_0"), F.abs("pca_1").alias("pca_1"), F.lit(explained[0]).alias("explained_0"))


_NUMERIC = ["y", "x1", "x2", "x3", "c1", "k", "n1"]


@register("collinear_table", f"WITH {fx.REG_SQL} SELECT id, y, x3, c1, k FROM reg", doubles=["y", "x3", "k"])
def collinear_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table without its collinear columns (x1 and x2 follow y, n1 follows x3)."""
    return profile.remove_collinear(fx.reg(spark, sf_dir).select("id", *_NUMERIC), _NUMERIC, 0.95, keep=["y"])


@register("target_corr_table", f"WITH {fx.REG_SQL} SELECT x1, x2, y FROM reg", doubles=["x1", "x2", "y"])
def target_corr_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns correlated with the target, and the target."""
    return profile.select_target_correlated(fx.reg(spark, sf_dir), _NUMERIC, "y", 0.5)


_NULL_KEYS = "CASE WHEN event_id % 10 <> 0 THEN value END"


@register(
    "row_index_null_keys",
    f"SELECT event_id, row_number() OVER (ORDER BY {_NULL_KEYS} ASC NULLS FIRST, event_id) AS row_index FROM events",
)
def row_index_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an order key come first and none is lost, cut into many ranges."""
    e = fx.t(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("k"))
    return ordered.add_row_index(e, ["k", "event_id"], rows_per_bucket=5_000).select("event_id", "row_index")


@register(
    "holdout_repeated_keys",
    """SELECT 'test' AS split, CAST(ceil(count(*) * 0.2) AS BIGINT) AS n FROM lineitem
UNION ALL SELECT 'train', count(*) - CAST(ceil(count(*) * 0.2) AS BIGINT) FROM lineitem""",
)
def holdout_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact sizes where rows share their key."""
    tagged = split.holdout_split(fx.t(spark, sf_dir, "lineitem"), "l_returnflag", 0.2)
    return tagged.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
