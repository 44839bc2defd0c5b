"""Learners held to closed forms: boosted stumps, single splits, fitted imputers.

A tree of one split on a 0/1 feature predicts the mean of either side, so after
t rounds of step s a boosted prediction is the constant plus the side's
deviation times 1 - (1 - s)^t: SQL gives every round's errors, the round that
patience stops at, the best one and the averaged predictions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.operators import flows, impute, models, split
from tabkiln.plans import fixtures as fx
from tabkiln.plans.registry import register
from tabkiln.session import checkpoint_dir

_STUMP = {"maxIter": 12, "stepSize": 0.3, "maxDepth": 1, "patience": 3, "checkpoint_every": 4}

_BOOST_CTE = f"""{fx.REG_SQL},
tagged AS (SELECT id, y, CASE WHEN c1 < 2 THEN 1.0 ELSE 0.0 END AS b,
                  row_number() OVER (ORDER BY md5('120:' || CAST(id AS VARCHAR)), id) <= ceil(count(*) OVER () * 0.2) AS test FROM reg),
folds AS (SELECT id, y, b, ntile(2) OVER (ORDER BY id) - 1 AS fold FROM tagged WHERE NOT test),
base AS (SELECT k, avg(y) AS f0 FROM folds, (VALUES (0), (1)) v(k) WHERE fold <> k GROUP BY k),
side AS (SELECT k, b, avg(y) - any_value(f0) AS d, any_value(f0) AS f0 FROM folds JOIN base ON fold <> k GROUP BY k, b),
scored AS (SELECT s.k, t.t, o.fold, o.y - (s.f0 + s.d * (1 - 0.7 ** t.t)) AS e
           FROM folds o JOIN side s ON s.b = o.b, (SELECT unnest(range(0, 13)) AS t) t),
errors AS (SELECT k, t, sqrt(avg(e * e) FILTER (fold <> k)) AS train, sqrt(avg(e * e) FILTER (fold = k)) AS valid FROM scored GROUP BY k, t),
seen AS (SELECT k, t, train, valid, (SELECT arg_min(i.t, (i.valid, i.t)) FROM errors i WHERE i.k = errors.k AND i.t <= errors.t) AS best FROM errors),
stops AS (SELECT k, coalesce(min(t) FILTER (t - best >= 3), 12) AS stop FROM seen GROUP BY k),
bests AS (SELECT k, best FROM seen JOIN stops USING (k) WHERE t = stop)"""

_ROUNDS_SQL = f"""WITH {_BOOST_CTE}
SELECT CAST(k AS INTEGER) AS fold, CAST(t AS INTEGER) AS round, train, valid, t = b.best AS best
FROM seen JOIN stops USING (k) JOIN bests b USING (k) WHERE t <= stop"""


def _stump_fit(spark: SparkSession, sf_dir: str) -> models.CvResult:
    r = fx.reg(spark, sf_dir).select("id", "y", F.when(F.col("c1") < 2, 1.0).otherwise(0.0).alias("b"))
    tagged = split.holdout_split(r, "id", 0.2, seed=120)
    train, test = (tagged.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    return models.cv_regression(train, test, "id", "y", ["b"], "gbt", 2, _STUMP)


@register("boost_rounds", _ROUNDS_SQL, doubles=["train", "valid"])
def boost_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every round's errors until patience ends, and the best round, per fold."""
    return _stump_fit(spark, sf_dir).rounds


_BOOST_PRED_SQL = f"""WITH {_BOOST_CTE}
SELECT t.id, avg(s.f0 + s.d * (1 - 0.7 ** b.best)) AS y_pred_gbt
FROM tagged t JOIN side s ON s.b = t.b JOIN bests b ON b.k = s.k WHERE t.test GROUP BY t.id"""


@register("boost_predictions", _BOOST_PRED_SQL, doubles=["y_pred_gbt"])
def boost_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: test predictions of both folds' ensembles, each cut back to its best round, averaged."""
    return _stump_fit(spark, sf_dir).predictions


_BOOST_METRICS_SQL = f"""WITH {_BOOST_CTE},
per AS (SELECT k, train, valid, best FROM errors JOIN bests USING (k) WHERE t = best),
oof AS (SELECT e FROM scored JOIN bests USING (k) WHERE t = best AND fold = k)
SELECT CAST(k AS VARCHAR) AS fold, train, valid, CAST(best AS INTEGER) AS n_trees FROM per
UNION ALL SELECT 'overall', (SELECT avg(train) FROM per),
  1 - (SELECT sum(e * e) FROM oof) / (SELECT count(*) * var_pop(y) FROM folds), NULL"""


@register("boost_metrics", _BOOST_METRICS_SQL, doubles=["train", "valid"])
def boost_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the best rounds, their number of trees and the out-of-fold R^2."""
    return _stump_fit(spark, sf_dir).metrics


_SPLIT_FEATURES = "CASE WHEN c1 < 2 THEN 1.0 ELSE 0.0 END AS b1, CASE WHEN y > 150 THEN 1.0 ELSE 0.0 END AS b2, CASE WHEN x3 < 50 THEN 1.0 ELSE 0.0 END AS b3"
_GAIN = "(count(*) FILTER ({0} = 1) * pow(avg(y) FILTER ({0} = 1), 2) + count(*) FILTER ({0} = 0) * pow(avg(y) FILTER ({0} = 0), 2))"
_GAINS = "unnest([{'feature': 'b1', 'gain': %s}, {'feature': 'b2', 'gain': %s}, {'feature': 'b3', 'gain': %s}], recursive := true)" % tuple(
    _GAIN.format(b) for b in ("b1", "b2", "b3"))


def _binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.reg(spark, sf_dir).select(
        "id", "y", F.when(F.col("c1") < 2, 1.0).otherwise(0.0).alias("b1"),
        F.when(F.col("y") > 150, 1.0).otherwise(0.0).alias("b2"), F.when(F.col("x3") < 50, 1.0).otherwise(0.0).alias("b3"))


@register(
    "importance_single_split",
    f"""WITH {fx.REG_SQL}, r AS (SELECT y, {_SPLIT_FEATURES} FROM reg), g AS (SELECT {_GAINS} FROM r)
SELECT feature, CASE WHEN row_number() OVER (ORDER BY gain DESC) = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS importance FROM g""",
)
def importance_single_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of one split gives all importance to the feature that explains most."""
    return models.feature_importance(_binary(spark, sf_dir), "y", ["b1", "b2", "b3"], "dt", params={"maxDepth": 1})


@register(
    "important_features_single_split",
    f"""WITH {fx.REG_SQL}, r AS (SELECT y, {_SPLIT_FEATURES} FROM reg), g AS (SELECT {_GAINS} FROM r),
i AS (SELECT feature, row_number() OVER (ORDER BY gain DESC) = 1 AS top FROM g),
n AS (SELECT feature, row_number() OVER (ORDER BY top DESC, feature) AS rk FROM i)
SELECT CAST(row_number() OVER (ORDER BY rk) - 1 AS INTEGER) AS rank, feature FROM n WHERE rk <= 2 AND feature <> 'b1'""",
)
def important_features_single_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two most important features, without those to skip."""
    r = _binary(spark, sf_dir).drop("id")
    names = models.important_features(r, "y", skip=["b1"], learner="dt", limit=2, params={"maxDepth": 1})
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "rank int, feature string")


@register(
    "cv_importance_single_split",
    f"""WITH {fx.REG_SQL}, r AS (SELECT id, y, {_SPLIT_FEATURES} FROM reg),
f AS (SELECT *, ntile(3) OVER (ORDER BY id) - 1 AS fold FROM r),
g AS (SELECT k, {_GAINS} FROM f, (VALUES (0), (1), (2)) v(k) WHERE fold <> k GROUP BY k),
w AS (SELECT feature, row_number() OVER (PARTITION BY k ORDER BY gain DESC) = 1 AS top FROM g)
SELECT feature, avg(CASE WHEN top THEN 1.0 ELSE 0.0 END)::DOUBLE AS importance FROM w GROUP BY feature""",
    doubles=["importance"],
)
def cv_importance_single_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances averaged over three folds."""
    return models.cv_regression(_binary(spark, sf_dir), None, "id", "y", ["b1", "b2", "b3"], "dt", 3, {"maxDepth": 1}).importance


# --------------------------------------------------------------------------
# fitted imputers, applied to rows they were not fitted on
# --------------------------------------------------------------------------

_CHAIN_SQL = f"""WITH {fx.REG_SQL},
r AS (SELECT id, CASE WHEN c1 < 2 THEN 1.0 ELSE 0.0 END AS b1, CASE WHEN id % 4 <> 0 THEN CASE WHEN x3 < 50 THEN 1.0 ELSE 0.0 END END AS m1,
             CASE WHEN id % 7 <> 1 THEN y END AS m2 FROM reg),
f1 AS (SELECT b1, avg(m1) AS fill FROM r WHERE id % 3 <> 0 AND m1 IS NOT NULL GROUP BY b1),
s1 AS (SELECT id, coalesce(m1, fill) AS m1, m2 FROM r JOIN f1 USING (b1)),
v AS (SELECT m1, count(*) AS n, sum(m2) AS s FROM s1 WHERE id % 3 <> 0 AND m2 IS NOT NULL GROUP BY m1),
c AS (SELECT m1 AS cut, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s FROM v WINDOW w AS (ORDER BY m1)),
best AS (SELECT cut, sl / nl AS low, (s - sl) / (n - nl) AS high FROM c WHERE nl < n
         ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)
SELECT id, m1, coalesce(m2, CASE WHEN m1 <= cut THEN low ELSE high END) AS m2 FROM s1, best WHERE id % 3 = 0"""


@register("impute_chain_dt", _CHAIN_SQL, doubles=["m1", "m2"])
def impute_chain_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-split trees fitted on two thirds of the rows and applied to the rest; m2 follows the filled m1."""
    r = fx.reg(spark, sf_dir).select(
        "id", F.when(F.col("c1") < 2, 1.0).otherwise(0.0).alias("b1"),
        F.when(F.col("id") % 4 != 0, F.when(F.col("x3") < 50, 1.0).otherwise(0.0)).alias("m1"),
        F.when(F.col("id") % 7 != 1, F.col("y")).alias("m2"))
    chain = impute.fit_imputer(r.filter("id % 3 <> 0"), ["m1", "m2"], "dt", features={"m1": ["b1"], "m2": ["m1"]}, key="id", max_depth=1)
    return chain.transform(r.filter("id % 3 = 0")).select("id", "m1", "m2")


_LABEL_SQL = f"""WITH {fx.NULLABLE_SQL},
d AS (SELECT doc_id, n_chars > 1500 AS long, quality, CAST(toxic AS DOUBLE) AS toxic FROM nullable),
t AS (SELECT * FROM d WHERE doc_id % 3 <> 0),
q AS (SELECT long, quality, count(*) AS n, (SELECT count(*) FROM t a WHERE a.quality = t.quality) AS freq FROM t
      WHERE quality IS NOT NULL GROUP BY long, quality),
m AS (SELECT long, quality FROM (SELECT *, row_number() OVER (PARTITION BY long ORDER BY n DESC, freq DESC, quality) AS k FROM q) WHERE k = 1),
x AS (SELECT long, avg(toxic) AS toxic FROM t WHERE toxic IS NOT NULL GROUP BY long)
SELECT doc_id, coalesce(d.quality, m.quality) AS quality, coalesce(d.toxic, x.toxic) AS toxic
FROM d JOIN m USING (long) JOIN x USING (long) WHERE doc_id % 3 = 0"""


@register("impute_chain_rf", _LABEL_SQL, doubles=["toxic"])
def impute_chain_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest of one unsampled stump, saved, loaded and applied to new rows: majority label, mean number."""
    d = fx.nullable(spark, sf_dir).select(
        "doc_id", (F.col("n_chars") > 1500).cast("double").alias("long"), "quality", F.col("toxic").cast("double").alias("toxic"))
    chain = impute.fit_imputer(d.filter("doc_id % 3 <> 0"), ["quality", "toxic"], "rf", categorical=["quality"], features=["long"],
                               key="doc_id", num_trees=1, max_depth=1, bootstrap=False)
    path = f"{checkpoint_dir(spark).rstrip('/')}/imputer-{uuid.uuid4().hex}"
    chain.save(spark, path)
    return impute.load_imputer(spark, path).transform(d.filter("doc_id % 3 = 0")).select("doc_id", "quality", "toxic")


@register("pipeline_imputer_rowwise", "SELECT count(*) FILTER (o_orderkey % 2 = 0) AS n_rows, 0::BIGINT AS n_moved FROM orders")
def pipeline_imputer_rowwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With forest imputation a row's score is the same whatever rows are scored beside it."""
    raw = fx.reg(spark, sf_dir).select("id", "y", F.when(F.col("id") % 4 != 0, F.col("x1")).alias("m1"), "n1", "x3")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/flow-{uuid.uuid4().hex}"
    paths = flows.train_only(raw, "id", "y", folder, {"dt": {"maxDepth": 4}}, imputer="rf")
    every = flows.predict(raw, folder, paths).select("id", "y_pred_dt")
    some = flows.predict(raw.filter("id % 2 = 0"), folder, paths).select("id", F.col("y_pred_dt").alias("alone"))
    moved = F.count(F.when(~F.col("y_pred_dt").eqNullSafe(F.col("alone")), 1))
    return every.join(some, "id").agg(F.count(F.lit(1)).alias("n_rows"), moved.alias("n_moved"))
