"""Queries for profiling, roles and cleaning operators (step 2 of the plan)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.operators import profile, project, split
from tabkiln.plans import fixtures as fx
from tabkiln.plans.registry import register
from tabkiln.session import checkpoint_dir
from tabkiln.sources import write_parquet

_REG_COLS = ["id", "y", "x1", "x2", "x3", "c1", "k", "n1", "n2"]


def _unpivot_sql(select_list: str, cols: list[str], src: str, name: str, value: str) -> str:
    return (
        f"SELECT * FROM (UNPIVOT (SELECT {select_list} FROM {src}) "
        f"ON {', '.join(cols)} INTO NAME {name} VALUE {value})"
    )


_NULL_SQL = f"""WITH {fx.REG_SQL}
SELECT "column", null_frac, null_frac > 0.4 AS rejected FROM (
{_unpivot_sql(", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS {c}" for c in _REG_COLS), _REG_COLS, "reg", '"column"', "null_frac")})"""


@register("null_profile", _NULL_SQL, doubles=["null_frac"])
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: NULL share per column, rejected above 0.4."""
    return profile.null_profile(fx.reg(spark, sf_dir), 0.4)


_ROLE_COLS = [c for c in _REG_COLS if c != "y"]
_FLOATS = ["x1", "x2", "x3", "k", "n1", "n2"]
_ROLES_SQL = f"""WITH {fx.REG_SQL},
d AS ({_unpivot_sql(", ".join(f"count(DISTINCT {c}) AS {c}" for c in _ROLE_COLS), _ROLE_COLS, "reg", '"column"', "n_distinct")})
SELECT "column", CAST(n_distinct AS BIGINT) AS n_distinct,
       "column" IN ({", ".join(repr(c) for c in _FLOATS)}) AS is_float,
       n_distinct < 20 AND "column" NOT IN ({", ".join(repr(c) for c in _FLOATS)}) AS categorical
FROM d"""


@register("cat_roles", _ROLES_SQL)
def cat_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: categorical iff fewer than 20 distinct values and not floating."""
    return profile.distinct_profile(fx.reg(spark, sf_dir), "y", 20, exclude_float=True)


_PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
_ROLES_ANY_SQL = f"""WITH d AS ({_unpivot_sql(", ".join(f"count(DISTINCT {c}) AS {c}" for c in _PART_COLS), _PART_COLS, "part", '"column"', "n_distinct")})
SELECT "column", CAST(n_distinct AS BIGINT) AS n_distinct, "column" = 'p_retailprice' AS is_float,
       n_distinct < 30 AS categorical
FROM d"""


@register("cat_roles_any_type", _ROLES_ANY_SQL)
def cat_roles_any_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the same rule without the floating-column exclusion, on part."""
    return profile.distinct_profile(fx.t(spark, sf_dir, "part"), None, 30, exclude_float=False)


_DISTINCT_SQL = "SELECT DISTINCT lang FROM documents"


@register("distinct_categories", _DISTINCT_SQL)
def distinct_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct categories of a column."""
    return profile.distinct_values(fx.t(spark, sf_dir, "documents"), "lang")


# Fixed mapping used by the value_map query (the rest of the brands map to NULL).
BRAND_MAP = {"Brand#1": "first", "Brand#2": "second", "Brand#3": "third", "Brand#10": "tenth"}

_MAP_SQL = f"""SELECT p_partkey, p_brand,
  CASE p_brand {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BRAND_MAP.items())} END AS brand_name
FROM part"""


@register("value_map", _MAP_SQL)
def value_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value mapping, unmapped values become NULL."""
    p = fx.t(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return project.map_values(p, "p_brand", BRAND_MAP, out="brand_name")


_FILL_SQL = f"""WITH {fx.NULLABLE_SQL}
SELECT doc_id, lang, source, n_chars, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM nullable"""


@register("fill_nulls", _FILL_SQL)
def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill NULL labels with -1."""
    return project.fill_nulls(fx.nullable(spark, sf_dir), ["quality", "toxic"], -1)


_SUMDIFF_SQL = f"""WITH {fx.REG_SQL}
SELECT id, x1, x3, x1 + x3 AS s13, x1 - x3 AS d13, n1 + x3 AS sn FROM reg"""


@register("sum_diff_columns", _SUMDIFF_SQL, doubles=["x1", "x3", "s13", "d13", "sn"])
def sum_diff_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and differences of column pairs (NULL propagates)."""
    r = fx.reg(spark, sf_dir).select("id", "x1", "x3", "n1")
    r = project.sum_columns(r, [("x1", "x3", "s13"), ("n1", "x3", "sn")])
    r = project.diff_columns(r, [("x1", "x3", "d13")])
    return r.select("id", "x1", "x3", "s13", "d13", "sn")


_LOG_SQL = f"""WITH {fx.REG_SQL},
b AS (SELECT id, x3, x3 - 50.0 AS xs, n1 FROM reg)
SELECT id,
  CASE WHEN x3 = 0 THEN 0.0 WHEN x3 < 0 THEN NULL ELSE ln(x3) END AS x3,
  CASE WHEN xs = 0 THEN 0.0 WHEN xs < 0 THEN NULL ELSE ln(xs) END AS xs,
  CASE WHEN n1 = 0 THEN 0.0 WHEN n1 < 0 THEN NULL ELSE ln(n1) END AS n1
FROM b"""


@register("log_transform", _LOG_SQL, doubles=["x3", "xs", "n1"])
def log_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ln with 0 -> 0 and negatives -> NULL."""
    r = fx.reg(spark, sf_dir).select("id", "x3", (F.col("x3") - 50.0).alias("xs"), "n1")
    return project.log_transform(r, ["x3", "xs", "n1"])


_FORMULA_SQL = f"""WITH {fx.REG_SQL}
SELECT id,
  CASE WHEN x3 = 0 THEN 0.0 ELSE CAST(x3 * 2 + 1 AS DOUBLE) END AS x3,
  CASE WHEN c1 = 0 THEN 0.0 ELSE CAST(c1 * c1 AS DOUBLE) END AS c1,
  CASE WHEN n1 = 0 THEN 0.0 ELSE CAST(sqrt(n1) AS DOUBLE) END AS n1
FROM reg"""


@register("formula_columns", _FORMULA_SQL, doubles=["x3", "c1", "n1"])
def formula_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-value SQL formulas in x (0 stays 0, NULL stays NULL)."""
    r = fx.reg(spark, sf_dir).select("id", "x3", "c1", "n1")
    return project.apply_formula(r, {"x3": "x * 2 + 1", "c1": "x * x", "n1": lambda x: F.sqrt(x)})


_DOWNCAST_SQL = f"""WITH {fx.REG_SQL}
SELECT CAST(id AS INTEGER) AS id,
       coalesce(CAST(trunc(y) AS INTEGER), 0) AS y,
       CAST(x1 AS FLOAT) AS x1, CAST(x3 AS FLOAT) AS x3, c1, CAST(n1 AS FLOAT) AS n1
FROM reg"""


@register("downcast_types", _DOWNCAST_SQL)
def downcast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Double -> float, long -> int, the target -> int with NULL -> 0 (truncating)."""
    r = fx.reg(spark, sf_dir).select("id", "y", "x1", "x3", "c1", "n1")
    return project.downcast_types(r, int_fill_cols=["y"])


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fx.reg(spark, sf_dir)
    m = F.col("id") % 7
    w = (
        F.when(m == 0, F.lit(float("inf")))
        .when(m == 1, F.lit(float("-inf")))
        .when(m == 2, F.lit(float("nan")))
        .when(m == 3, F.lit(None).cast("double"))
        .otherwise(F.col("x3"))
    )
    return r.select("id", w.alias("w"), "n1")


_SANITIZE_SQL = f"""WITH {fx.REG_SQL},
b AS (SELECT id, CASE WHEN id % 7 = 0 THEN 'inf'::DOUBLE WHEN id % 7 = 1 THEN '-inf'::DOUBLE
                      WHEN id % 7 = 2 THEN 'nan'::DOUBLE WHEN id % 7 = 3 THEN NULL ELSE x3 END AS w, n1 FROM reg)
SELECT id,
  CASE WHEN w IS NULL OR isnan(w) OR isinf(w) THEN 0.0 ELSE w END AS w,
  CASE WHEN n1 IS NULL OR isnan(n1) OR isinf(n1) THEN 0.0 ELSE n1 END AS n1
FROM b"""


@register("sanitize_inf", _SANITIZE_SQL, doubles=["w", "n1"])
def sanitize_inf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: NULL, NaN and +-inf become 0 in floating columns."""
    return project.sanitize_numbers(_dirty(spark, sf_dir))


_DROPNULLCOL_SQL = f"""WITH {fx.NULLABLE_SQL}
SELECT doc_id, lang, source, n_chars, quality, toxic FROM nullable"""


@register("drop_null_columns", _DROPNULLCOL_SQL)
def drop_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that is NULL on every row is dropped; the others stay."""
    n = fx.nullable(spark, sf_dir).withColumn("never", F.when(F.col("doc_id") < 0, F.col("n_chars")))
    return project.drop_all_null_columns(n)


_COMPLETE_SQL = f"""WITH {fx.NULLABLE_SQL}
SELECT * FROM nullable WHERE quality IS NOT NULL AND toxic IS NOT NULL"""


@register("complete_rows", _COMPLETE_SQL)
def complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without any NULL."""
    return project.complete_rows(fx.nullable(spark, sf_dir))


_NULLSIDE_SQL = f"""WITH {fx.NULLABLE_SQL}
SELECT doc_id, lang, n_chars FROM nullable WHERE quality IS NULL"""


@register("target_null_rows", _NULLSIDE_SQL)
def target_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows whose target is NULL (the side to be predicted)."""
    _, missing = project.split_on_null(fx.nullable(spark, sf_dir), "quality")
    return missing.select("doc_id", "lang", "n_chars")


_PROJECT_SQL = f"""WITH {fx.REG_SQL} SELECT y, id FROM reg"""


@register("project_drop", _PROJECT_SQL, doubles=["y"])
def project_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection in a given order, then a drop."""
    r = project.select_columns(fx.reg(spark, sf_dir), ["y", "x3", "id"])
    return project.drop_columns(r, ["x3"])


_NORMALIZE_SQL = "SELECT p_partkey, lower(trim(p_type)) AS p_type, lower(trim(p_brand)) AS p_brand FROM part"


@register("normalize_values", _NORMALIZE_SQL)
def normalize_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-case, trimmed values."""
    p = fx.t(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return project.normalize_values(p, ["p_type", "p_brand"])


_UNION_SQL = """SELECT d.doc_id, d.lang, d.n_chars, l.quality, 'train' AS type
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
UNION ALL
SELECT d.doc_id, d.lang, d.n_chars, NULL AS quality, 'test' AS type
FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id"""


@register("union_train_test", _UNION_SQL)
def union_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows as train, unlabelled rows as test, missing columns NULL."""
    d = fx.t(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    lab = fx.t(spark, sf_dir, "labels").select("doc_id", "quality")
    train = d.join(lab, "doc_id", "inner")
    test = d.join(lab, "doc_id", "left_anti")
    return split.union_tagged({"train": train, "test": test}).select("doc_id", "lang", "n_chars", "quality", "type")


_HEAD_SQL = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20"


@register("head_sample", _HEAD_SQL, doubles=["o_totalprice"])
def head_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows in key order for display (a top-k: the limit is the feature)."""
    o = fx.t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.orderBy("o_orderkey").limit(20)


_CLEAN_RT_SQL = f"""WITH {fx.NULLABLE_SQL}
SELECT doc_id, lang, source, n_chars, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM nullable"""


@register("cleaned_parquet_roundtrip", _CLEAN_RT_SQL)
def cleaned_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: a cleaned table written as parquet to the shared folder and read back."""
    cleaned = project.fill_nulls(fx.nullable(spark, sf_dir), ["quality", "toxic"], -1)
    path = f"{checkpoint_dir(spark).rstrip('/')}/cleaned-{uuid.uuid4().hex}"
    write_parquet(cleaned, path)
    return spark.read.parquet(path)
