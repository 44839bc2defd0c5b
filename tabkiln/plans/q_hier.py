"""Queries for hierarchical multi-label evaluation (step 6)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.operators import hierarchy, metrics
from tabkiln.plans import fixtures as fx
from tabkiln.plans.q_metrics import _counts_sql, grid_values_sql
from tabkiln.plans.registry import register
from tabkiln.session import checkpoint_dir
from tabkiln.sources import write_reports

_LBL = "level, kind, label_idx, label_name"


def _thr_cte(grid) -> str:
    return f"""hp AS (SELECT *, 1.0 / (1.0 + exp(-logit)) AS prob FROM hier),
lsweep AS (
  SELECT {_LBL}, grid.t, grid.threshold, {_counts_sql("CASE WHEN prob >= grid.threshold THEN 1 ELSE 0 END", "y")}
  FROM hp, {grid_values_sql(grid)} GROUP BY {_LBL}, grid.t, grid.threshold),
lf1 AS (
  SELECT *, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
         (tp + fp > 0 AND tn + fn > 0 AND tp + fn > 0 AND fp + tn > 0) AS eligible
  FROM lsweep),
lbest AS (
  SELECT {_LBL}, threshold FROM (
    SELECT *, row_number() OVER (PARTITION BY level, kind, label_idx ORDER BY f1 DESC, t ASC) AS rn
    FROM lf1 WHERE eligible AND f1 > 0) WHERE rn = 1),
thr AS (
  SELECT l.level, l.kind, l.label_idx, l.label_name, coalesce(b.threshold, 0.5) AS threshold
  FROM (SELECT DISTINCT {_LBL} FROM hier) l
  LEFT JOIN lbest b ON b.level = l.level AND b.kind = l.kind AND b.label_idx = l.label_idx)"""


_THR_SQL = f"WITH {fx.HIER_SQL},\n{_thr_cte(metrics.LABEL_GRID)}\nSELECT * FROM thr"
_THR_FINE_SQL = f"WITH {fx.HIER_SQL},\n{_thr_cte(metrics.LABEL_GRID_FINE)}\nSELECT * FROM thr"


@register("label_thresholds", _THR_SQL, doubles=["threshold"])
def label_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-label thresholds on arange(0.1, 1.0, 0.1), both classes required, default 0.5."""
    return hierarchy.label_thresholds(fx.hier_long(spark, sf_dir), metrics.LABEL_GRID)


@register("label_thresholds_fine", _THR_FINE_SQL, doubles=["threshold"])
def label_thresholds_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on the finer grid arange(0.05, 0.95, 0.05)."""
    return hierarchy.label_thresholds(fx.hier_long(spark, sf_dir), metrics.LABEL_GRID_FINE)


def _eval_sql(modes: list[str]) -> str:
    parts = []
    if "at_0.5" in modes:
        parts.append("SELECT level, kind, label_idx, id, y, 'at_0.5' AS threshold_mode, "
                     "CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS pred FROM sc")
    if "optimized" in modes:
        parts.append("SELECT level, kind, label_idx, id, y, 'optimized', "
                     "CASE WHEN prob >= threshold THEN 1 ELSE 0 END FROM sc")
    return f"""WITH {fx.HIER_SQL},
{_thr_cte(metrics.LABEL_GRID)},
sc AS (SELECT hp.*, thr.threshold FROM hp JOIN thr
       ON thr.level = hp.level AND thr.kind = hp.kind AND thr.label_idx = hp.label_idx),
modes AS ({" UNION ALL ".join(parts)}),
pl AS (SELECT level, kind, threshold_mode, label_idx, {_counts_sql("pred", "y")} FROM modes
       GROUP BY level, kind, threshold_mode, label_idx),
plr AS (SELECT *,
          CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p,
          CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r,
          CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f,
          CAST(tp + fn AS DOUBLE) AS s
        FROM pl),
agg AS (SELECT level, kind, threshold_mode, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn,
          avg(p) AS precision_macro, avg(r) AS recall_macro, avg(f) AS f1_macro,
          CASE WHEN sum(s) = 0 THEN 0.0 ELSE sum(p * s) / sum(s) END AS precision_weighted,
          CASE WHEN sum(s) = 0 THEN 0.0 ELSE sum(r * s) / sum(s) END AS recall_weighted,
          CASE WHEN sum(s) = 0 THEN 0.0 ELSE sum(f * s) / sum(s) END AS f1_weighted
        FROM plr GROUP BY level, kind, threshold_mode),
acc AS (SELECT level, kind, threshold_mode, avg(m) AS accuracy FROM (
          SELECT level, kind, threshold_mode, id, min(CASE WHEN pred = y THEN 1 ELSE 0 END) AS m
          FROM modes GROUP BY level, kind, threshold_mode, id) GROUP BY level, kind, threshold_mode)
SELECT agg.level, agg.kind, agg.threshold_mode,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision_micro,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall_micro,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_micro,
  precision_macro, recall_macro, f1_macro, precision_weighted, recall_weighted, f1_weighted, accuracy
FROM agg JOIN acc ON acc.level = agg.level AND acc.kind = agg.kind AND acc.threshold_mode = agg.threshold_mode"""


_EVAL_DOUBLES = [
    f"{m}_{a}" for a in ("micro", "macro", "weighted") for m in ("precision", "recall", "f1")
] + ["accuracy"]


@register("multilabel_averages", _eval_sql(["at_0.5"]), doubles=_EVAL_DOUBLES)
def multilabel_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro, macro, weighted P/R/F1 and exact-match accuracy per level and kind at 0.5."""
    return hierarchy.multilabel_metrics(fx.hier_long(spark, sf_dir))


@register("hier_evaluation", _eval_sql(["at_0.5", "optimized"]), doubles=_EVAL_DOUBLES)
def hier_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every level and kind at 0.5 and at tuned per-label thresholds, in one job."""
    return hierarchy.evaluate(fx.hier_long(spark, sf_dir))


_PER_CLASS_SQL = f"""WITH {fx.HIER_SQL},
{_thr_cte(metrics.LABEL_GRID)},
sc AS (SELECT hp.*, thr.threshold, CASE WHEN prob >= thr.threshold THEN 1 ELSE 0 END AS pred FROM hp JOIN thr
       ON thr.level = hp.level AND thr.kind = hp.kind AND thr.label_idx = hp.label_idx),
c0 AS (SELECT level, kind, label_idx, label_name, any_value(threshold) AS optimal_threshold,
              {_counts_sql("pred", "y")}, max(y) = min(y) AS single
       FROM sc GROUP BY level, kind, label_idx, label_name),
c AS (SELECT level, kind, label_idx, label_name, optimal_threshold,
             CASE WHEN single THEN 0 ELSE tp END AS tp, CASE WHEN single THEN 0 ELSE fp END AS fp,
             CASE WHEN single THEN 0 ELSE tn END AS tn, CASE WHEN single THEN 0 ELSE fn END AS fn FROM c0)
SELECT level, kind, label_idx, label_name, optimal_threshold,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_score,
  CAST(tp AS BIGINT) AS tp, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn
FROM c"""


@register("per_class_report", _PER_CLASS_SQL, doubles=["optimal_threshold", "precision", "recall", "f1_score"])
def per_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: per label tuned threshold, P/R/F1 and counts (0 when the truth is single-class)."""
    return hierarchy.per_class_report(fx.hier_long(spark, sf_dir))


_BCE_CTE = f"""{fx.HIER_SQL},
bce AS (SELECT level, kind,
          avg(greatest(logit, 0.0) - logit * CAST(y AS DOUBLE) + ln(1 + exp(-abs(logit)))) AS loss
        FROM hier GROUP BY level, kind),
bw AS (SELECT *, (1.0::DOUBLE + (level - 1) * 0.1::DOUBLE)
                  * CASE WHEN kind = 'sub' THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM bce)"""

_BCE_SQL = f"WITH {_BCE_CTE}\nSELECT level, kind, loss, weight, loss * weight AS weighted_loss FROM bw"


@register("hier_bce_loss", _BCE_SQL, doubles=["loss", "weight", "weighted_loss"])
def hier_bce_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean BCE-with-logits per level and kind with the level/sub weights."""
    return hierarchy.hierarchical_bce(fx.hier_long(spark, sf_dir))


_TOTAL_SQL = f"WITH {_BCE_CTE}\nSELECT sum(loss * weight) AS total_loss FROM bw"


@register("hier_total_loss", _TOTAL_SQL, doubles=["total_loss"])
def hier_total_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted sum of the per level and kind losses."""
    return hierarchy.total_loss(hierarchy.hierarchical_bce(fx.hier_long(spark, sf_dir)))


def _hier_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.t(spark, sf_dir, "embeddings")

    def logits(base: int, n: int):
        return F.transform(
            F.sequence(F.lit(0), F.lit(n - 1)),
            lambda i: F.element_at("embedding", ((i + base) % 64) + 1).cast("double") * 10.0,
        )

    return e.select(
        F.col("vec_id").alias("id"),
        logits(0, 10).alias("main_l1"),
        logits(10, 30).alias("sub_l1"),
        logits(40, 10).alias("main_l2"),
        logits(50, 30).alias("sub_l2"),
    )


def _wide_cols() -> list[tuple[str, str]]:
    cols = []
    for level, base in ((1, 0), (2, 40)):
        for i in range(10):
            x = f"CAST(embedding[{(i + base) % 64 + 1}] AS DOUBLE) * 10.0"
            cols.append((f"main_prob_level{level}_label{i}", f"1.0 / (1.0 + exp(-({x})))"))
            cols.append((f"main_pred_level{level}_label{i}", f"CASE WHEN 1.0 / (1.0 + exp(-({x}))) >= 0.5 THEN 1 ELSE 0 END"))
        for i in range(10):
            for j in range(3):
                x = f"CAST(embedding[{(i * 3 + j + base + 10) % 64 + 1}] AS DOUBLE) * 10.0"
                cols.append((f"sub_prob_level{level}_main{i}_sub{j}", f"1.0 / (1.0 + exp(-({x})))"))
                cols.append(
                    (f"sub_pred_level{level}_main{i}_sub{j}", f"CASE WHEN 1.0 / (1.0 + exp(-({x}))) >= 0.5 THEN 1 ELSE 0 END")
                )
    return cols


_WIDE_SQL = "SELECT vec_id AS id, " + ", ".join(f"{e} AS {n}" for n, e in _wide_cols()) + " FROM embeddings"


@register("wide_predictions", _WIDE_SQL, doubles=[n for n, _ in _wide_cols() if "_prob_" in n])
def wide_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: scores to a static wide table of probabilities and 0/1 predictions per level."""
    arr = _hier_arrays(spark, sf_dir)
    return hierarchy.wide_predictions(arr, "id", {1: ("main_l1", "sub_l1"), 2: ("main_l2", "sub_l2")}, 10, 3)


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.t(spark, sf_dir, "embeddings")
    codes = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: ((F.col("vec_id") * 7 + i) % 50).cast("int"))
    return e.select(
        F.col("vec_id").alias("id"),
        F.struct(codes.alias("business_codes"), F.slice("embedding", 1, 10).alias("scores")).alias("main_label_info"),
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (F.col("label") == i).cast("int")).alias("main_label"),
        F.transform(
            F.sequence(F.lit(0), F.lit(9)),
            lambda i: F.transform(
                F.sequence(F.lit(0), F.lit(2)),
                lambda j: ((F.col("vec_id") % 10 == i) & (F.col("vec_id") % 3 == j)).cast("int"),
            ),
        ).alias("main_label_sub_label"),
    )


_NESTED_SQL = """SELECT vec_id AS id, CAST(i AS INTEGER) AS pos, CAST((vec_id * 7 + i) % 50 AS DOUBLE) AS code,
       CAST(embedding[i + 1] AS DOUBLE) AS score
FROM embeddings, range(0, 10) r(i)"""


@register("nested_features", _NESTED_SQL, doubles=["code", "score"])
def nested_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel arrays of a nested struct to (code, score) pairs."""
    return hierarchy.nested_pairs(_nested(spark, sf_dir), "id", "main_label_info", "business_codes", "scores")


_VIOL_SQL = """SELECT vec_id AS id, CAST(i AS INTEGER) AS main_idx, CAST(j AS INTEGER) AS sub_idx
FROM embeddings, range(0, 10) a(i), range(0, 3) b(j)
WHERE label <> i AND vec_id % 10 = i AND vec_id % 3 = j"""


@register("sublabel_consistency", _VIOL_SQL)
def sublabel_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub labels set under a main label that is 0."""
    return hierarchy.sublabel_violations(_nested(spark, sf_dir), "id", "main_label", "main_label_sub_label")


_SUMMARY_SQL = f"""WITH q AS ({_eval_sql(["at_0.5", "optimized"])})
SELECT level, kind, f1_micro FROM q WHERE threshold_mode = 'at_0.5'"""


@register("micro_f1_summary", _SUMMARY_SQL, doubles=["f1_micro"])
def micro_f1_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The non-optimised micro-F1 per level and kind, filtered from the evaluation table."""
    ev = hierarchy.evaluate(fx.hier_long(spark, sf_dir))
    return ev.filter(F.col("threshold_mode") == "at_0.5").select("level", "kind", "f1_micro")


_REPORT_RT_SQL = _eval_sql(["at_0.5", "optimized"])


@register("report_sink_roundtrip", _REPORT_RT_SQL, doubles=_EVAL_DOUBLES)
def report_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation report written once, partitioned by level and kind, and read back."""
    ev = hierarchy.evaluate(fx.hier_long(spark, sf_dir))
    path = f"{checkpoint_dir(spark).rstrip('/')}/reports-{uuid.uuid4().hex}"
    write_reports(ev, path, keys=("level", "kind"))
    back = spark.read.parquet(path)
    return back.select(*ev.columns).withColumn("level", F.col("level").cast("int"))
