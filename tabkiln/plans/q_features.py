"""Queries for statistics, correlation pruning, scaling and encoding (step 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.operators import encode, joins, profile, project, reduce, scale
from tabkiln.plans import fixtures as fx
from tabkiln.plans.q_clean import _dirty
from tabkiln.plans.registry import register

_STAT_COLS = ["y", "x1", "x3", "c1", "n1", "n2"]

_STATS_SQL = f"""WITH {fx.REG_SQL}
{" UNION ALL ".join(f"SELECT '{c}' AS \"column\", avg(CAST({c} AS DOUBLE)) AS mean, min(CAST({c} AS DOUBLE)) AS min, max(CAST({c} AS DOUBLE)) AS max FROM reg" for c in _STAT_COLS)}"""


@register("column_stats", _STATS_SQL, doubles=["mean", "min", "max"])
def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: mean, min and max of several columns in one pass."""
    return profile.column_stats(fx.reg(spark, sf_dir), _STAT_COLS)


_CORR_COLS = ["y", "x1", "x2", "x3", "c1", "k", "n1"]


def _corr_sql(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return (
        f"covar_pop(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) / nullif("
        f"stddev_pop(CAST({a} AS DOUBLE)) FILTER (WHERE {both}) * stddev_pop(CAST({b} AS DOUBLE)) FILTER (WHERE {both}), 0)"
    )


_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{_CORR_COLS[i]}' AS col_a, '{_CORR_COLS[j]}' AS col_b, {i} AS pos_a, {j} AS pos_b, "
    f"{_corr_sql(_CORR_COLS[i], _CORR_COLS[j])} AS corr FROM reg"
    for j in range(len(_CORR_COLS))
    for i in range(j)
)

_CORR_SQL = f"WITH {fx.REG_SQL}\n{_PAIRS_SQL}"


@register("corr_matrix", _CORR_SQL, doubles=["corr"])
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: Pearson correlation of every column pair, NULL for a constant column."""
    return profile.correlation_pairs(fx.reg(spark, sf_dir), _CORR_COLS)


_COLLINEAR_SQL = f"""WITH {fx.REG_SQL}, pairs AS ({_PAIRS_SQL})
SELECT col_b AS "column", bool_or(coalesce(abs(corr) > 0.95, false)) AND col_b <> 'y' AS dropped
FROM pairs GROUP BY col_b
UNION ALL SELECT 'y', false"""


@register("remove_collinear", _COLLINEAR_SQL)
def remove_collinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column is dropped when an earlier column correlates above 0.95; the target is kept."""
    return profile.collinear_report(fx.reg(spark, sf_dir), _CORR_COLS, 0.95, keep=["y"])


_TARGET_COLS = ["x1", "x2", "x3", "c1", "k", "n1"]
_TARGET_SQL = f"""WITH {fx.REG_SQL}
SELECT "column", corr, coalesce(corr > 0.5, false) AS kept FROM (
{" UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_corr_sql(c, 'y')} AS corr FROM reg" for c in _TARGET_COLS)})"""


@register("high_target_corr", _TARGET_SQL, doubles=["corr"])
def high_target_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose signed correlation with the target is above 0.5."""
    return profile.target_corr_report(fx.reg(spark, sf_dir), _TARGET_COLS, "y", 0.5)


def _minmax_sql(c: str, lo: float, hi: float, src: str) -> str:
    mn, mx = f"min({c}) OVER ()", f"max({c}) OVER ()"
    return (
        f"CASE WHEN {mx} = {mn} THEN CASE WHEN {c} IS NOT NULL THEN {float(lo)} END "
        f"ELSE (CAST({c} AS DOUBLE) - {mn}) / ({mx} - {mn}) * {float(hi - lo)} + {float(lo)} END AS {c}"
    )


_MINMAX_SQL = f"""WITH {fx.REG_SQL}
SELECT id, {_minmax_sql("x1", 0, 10, "reg")}, {_minmax_sql("x3", 0, 10, "reg")}, {_minmax_sql("n1", 0, 10, "reg")},
       {_minmax_sql("k", 0, 10, "reg")}
FROM reg"""


@register("minmax_simple", _MINMAX_SQL, doubles=["x1", "x3", "n1", "k"])
def minmax_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """min-max scaling to (0, 10); a constant column maps to the range minimum."""
    r = fx.reg(spark, sf_dir).select("id", "x1", "x3", "n1", "k")
    return scale.fit_minmax(r, ["x1", "x3", "n1", "k"], (0.0, 10.0)).transform(r)


_AUTO_SQL = f"""WITH {fx.REG_SQL},
b AS (SELECT id, CASE WHEN id % 7 = 0 THEN 'inf'::DOUBLE WHEN id % 7 = 1 THEN '-inf'::DOUBLE
                      WHEN id % 7 = 2 THEN 'nan'::DOUBLE WHEN id % 7 = 3 THEN NULL ELSE x3 END AS w, n1 FROM reg),
s AS (SELECT id,
  CASE WHEN w IS NULL OR isnan(w) OR isinf(w) THEN 0.0 ELSE w END AS w,
  CASE WHEN n1 IS NULL OR isnan(n1) OR isinf(n1) THEN 0.0 ELSE n1 END AS n1
FROM b)
SELECT id, {_minmax_sql("w", 0, 1, "s")}, {_minmax_sql("n1", 0, 1, "s")} FROM s"""


@register("minmax_auto", _AUTO_SQL, doubles=["w", "n1"])
def minmax_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every floating column cleaned of NULL/NaN/inf, then scaled to (0, 1)."""
    clean = project.sanitize_numbers(_dirty(spark, sf_dir))
    floats = [c for c in clean.columns if c != "id"]
    return scale.fit_minmax(clean, floats, (0.0, 1.0)).transform(clean)


_STRAT_COLS = ["y", "x1", "x3", "c1"]


def _strat_sql(c: str) -> str:
    m = f"avg(CAST({c} AS DOUBLE)) OVER ()"
    hi = f"(CASE WHEN {m} > 1000 THEN 10.0 WHEN {m} > 100 THEN 5.0 WHEN {m} > 10 THEN 2.0 ELSE 1.0 END)"
    mn, mx = f"min(CAST({c} AS DOUBLE)) OVER ()", f"max(CAST({c} AS DOUBLE)) OVER ()"
    return f"CASE WHEN {mx} = {mn} THEN 0.0 ELSE (CAST({c} AS DOUBLE) - {mn}) / ({mx} - {mn}) * {hi} + 0.0 END AS {c}"


_STRAT_SQL = f"""WITH {fx.REG_SQL}
SELECT id, {", ".join(_strat_sql(c) for c in _STRAT_COLS)} FROM reg"""


@register("minmax_stratified", _STRAT_SQL, doubles=_STRAT_COLS)
def minmax_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """min-max with the range chosen by the column mean."""
    r = fx.reg(spark, sf_dir).select("id", *_STRAT_COLS)
    r = scale.replace_positive_inf(r, ["y", "x1", "x3"])
    return scale.fit_minmax_stratified(r, _STRAT_COLS).transform(r)


_CENTER_SQL = f"""WITH {fx.REG_SQL}
SELECT id, x3, n1,
  x3 - avg(x3) OVER () AS x3_minus_mean, x3 - max(x3) OVER () AS x3_minus_max, x3 - min(x3) OVER () AS x3_minus_min,
  n1 - avg(n1) OVER () AS n1_minus_mean, n1 - max(n1) OVER () AS n1_minus_max, n1 - min(n1) OVER () AS n1_minus_min
FROM reg"""


@register(
    "center_features",
    _CENTER_SQL,
    doubles=["x3", "n1"] + [f"{c}_minus_{k}" for c in ("x3", "n1") for k in ("mean", "max", "min")],
)
def center_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """differences to the column mean, max and min."""
    r = fx.reg(spark, sf_dir).select("id", "x3", "n1")
    return scale.fit_center(r, ["x3", "n1"], as_float=False).transform(r)


_PAIR_COLS = ["x3", "c1", "n1"]
_PAIR_SQL = f"""WITH {fx.REG_SQL}
SELECT id, {", ".join(
    f"CAST(CAST({a} AS DOUBLE) - CAST({b} AS DOUBLE) AS FLOAT) AS {a}_diff_{b}, "
    f"CAST(CAST({a} AS DOUBLE) + CAST({b} AS DOUBLE) AS FLOAT) AS {a}_sum_{b}, "
    f"CAST(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0) AS FLOAT) AS {a}_ratio_{b}"
    for a in _PAIR_COLS for b in _PAIR_COLS if a != b)}
FROM reg"""


@register("pair_features", _PAIR_SQL)
def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """difference, sum and ratio of every ordered column pair, as float32; x/0 -> NULL."""
    r = fx.reg(spark, sf_dir).select("id", *_PAIR_COLS)
    return scale.pair_features(r, _PAIR_COLS).drop(*_PAIR_COLS)


_LANGS = ["de", "en", "es", "fr"]
_SOURCES = [f"src{i}" for i in range(20)]
_ONEHOT_SQL = f"""SELECT doc_id, n_chars,
  {", ".join(f"CASE WHEN lang = '{v}' THEN 1 ELSE 0 END AS lang_{v}" for v in _LANGS)},
  {", ".join(f"CASE WHEN source = '{v}' THEN 1 ELSE 0 END AS source_{v}" for v in _SOURCES)}
FROM documents"""


@register("onehot_roles", _ONEHOT_SQL)
def onehot_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dummies for the categorical role columns (fewer than 25 distinct values)."""
    d = fx.t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    roles = profile.column_roles(d, None, 25)
    return encode.fit_onehot(d, roles.categorical, drop=True).transform(d)


_OH_TH_SQL = f"""WITH {fx.NULLABLE_SQL}
SELECT doc_id, source, n_chars,
  {", ".join(f"CASE WHEN lang = '{v}' THEN 1 ELSE 0 END AS lang_{v}" for v in _LANGS)},
  CASE WHEN quality = 0 THEN 1 ELSE 0 END AS quality_0, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS quality_1,
  CASE WHEN toxic = 0 THEN 1 ELSE 0 END AS toxic_0, CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS toxic_1
FROM nullable"""


@register("onehot_threshold", _OH_TH_SQL)
def onehot_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dummies for every column with fewer than 5 distinct values; NULL has no dummy."""
    n = fx.nullable(spark, sf_dir)
    return encode.fit_onehot_threshold(n, 5).transform(n)


_ADDBACK_SQL = f"""WITH {fx.REG_SQL}
SELECT r.id, r.y, o.o_orderstatus, o.o_orderpriority FROM reg r LEFT JOIN orders o ON o.o_orderkey = r.id"""


@register("add_back_column", _ADDBACK_SQL, doubles=["y"])
def add_back_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns brought back from the source table by key."""
    r = fx.reg(spark, sf_dir).select("id", "y")
    src = fx.t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus", "o_orderpriority")
    return joins.add_back_columns(r, src, "id", ["o_orderstatus", "o_orderpriority"])


@register("pca_features")
def pca_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: two centred principal components of the non-categorical columns (rows-only check)."""
    r = fx.reg(spark, sf_dir).select("id", "y", "x1", "x2", "x3")
    out, _ = reduce.pca_features(r, ["x1", "x2", "x3"], 2, keep=["id", "y"])
    return out


_INDEX_SQL = """SELECT doc_id, lang, source,
  CAST(dense_rank() OVER (ORDER BY lang) - 1 AS DOUBLE) AS lang_idx,
  CAST(dense_rank() OVER (ORDER BY source) - 1 AS DOUBLE) AS source_idx
FROM documents"""


@register("string_index", _INDEX_SQL)
def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """category codes in alphabetical order (unseen values get an extra code)."""
    d = fx.t(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    _, out = encode.index_categories(d, ["lang", "source"])
    return out
