"""Queries for order-dependent operators and splits (step 4 of the plan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.operators import ordered, split
from tabkiln.plans import fixtures as fx
from tabkiln.plans.registry import register

_ROW_INDEX_SQL = "SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) AS row_index FROM events"


@register("row_index", _ROW_INDEX_SQL)
def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive id 1..n in key order."""
    e = fx.t(spark, sf_dir, "events").select("event_id", "user_id")
    return ordered.add_row_index(e, "event_id", "row_index", start=1)


_FILL_SQL = f"""WITH {fx.ORDERED_SQL}
SELECT event_id, user_id,
  coalesce(v,
           last_value(v IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(v IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v
FROM ordered"""


@register("ffill_bfill", _FILL_SQL, doubles=["v"])
def ffill_bfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward fill, then backward fill for leading NULLs."""
    return ordered.fill_forward_backward(fx.ordered(spark, sf_dir), "event_id", ["v"])


_WIDE = "event_id % 7 * 100000000000000000000 + 10000000000000000000000000000000"
_WIDE_INDEX_SQL = f"""WITH e AS (SELECT event_id, user_id, value, CAST({_WIDE} AS DECIMAL(38, 0)) AS wide, event_id % 3 = 0 AS flag FROM events)
SELECT event_id, row_number() OVER w AS row_index,
  coalesce(last_value(CASE WHEN event_id % 5 = 0 THEN value END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(CASE WHEN event_id % 5 = 0 THEN value END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v
FROM e WINDOW w AS (ORDER BY wide, flag, event_id)"""


def _wide_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under a key beyond the range of a long, of which a double tells seven values apart."""
    e = fx.t(spark, sf_dir, "events")
    wide = (F.col("event_id") % 7).cast("decimal(10,0)") * F.lit("100000000000000000000").cast("decimal(21,0)")
    wide = (wide + F.lit("10000000000000000000000000000000").cast("decimal(32,0)")).cast("decimal(38,0)")
    return e.select("event_id", "user_id", wide.alias("wide"), (F.col("event_id") % 3 == 0).alias("flag"),
                    F.when(F.col("event_id") % 5 == 0, F.col("value")).alias("v"))


@register("row_index_fill_wide_keys", _WIDE_INDEX_SQL, doubles=["v"])
def row_index_fill_wide_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many ranges of a composite key of decimal, boolean and long."""
    keys = ["wide", "flag", "event_id"]
    filled = ordered.fill_forward_backward(_wide_events(spark, sf_dir), keys, ["v"], rows_per_bucket=5_000)
    return ordered.add_row_index(filled, keys, rows_per_bucket=5_000).select("event_id", "row_index", "v")


_WIDE_FOLD_SQL = f"""SELECT event_id, CAST(ntile(5) OVER (ORDER BY CAST({_WIDE} AS DECIMAL(38, 0)), event_id % 3 = 0, event_id) - 1 AS INTEGER) AS fold
FROM events"""


@register("kfold_wide_keys", _WIDE_FOLD_SQL)
def kfold_wide_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contiguous folds along a composite key that starts with a decimal."""
    folded = ordered.assign_folds(_wide_events(spark, sf_dir), ["wide", "flag", "event_id"], 5, rows_per_bucket=2_000)
    return folded.select("event_id", "fold")


_KFOLD_SQL = "SELECT o_orderkey, CAST(ntile(3) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders"


@register("kfold_assign", _KFOLD_SQL)
def kfold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contiguous 3-fold assignment, first n % k folds one row larger."""
    o = fx.t(spark, sf_dir, "orders").select("o_orderkey")
    return ordered.assign_folds(o, "o_orderkey", 3)


_HOLDOUT_SQL = """WITH r AS (
  SELECT o_orderkey, o_custkey,
         row_number() OVER (ORDER BY md5('120:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rk,
         count(*) OVER () AS n
  FROM orders)
SELECT o_orderkey, o_custkey, CASE WHEN rk <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r"""


@register("holdout_split", _HOLDOUT_SQL)
def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded split with exactly ceil(0.2 n) test rows."""
    o = fx.t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return split.holdout_split(o, "o_orderkey", 0.2, seed=120)


_THREE_SQL = """WITH r AS (
  SELECT o_orderkey,
         row_number() OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rk,
         count(*) OVER () AS n
  FROM orders),
c AS (SELECT *, ceil(n * 0.4) AS held FROM r)
SELECT o_orderkey,
       CASE WHEN rk <= ceil(held * 0.5) THEN 'test' WHEN rk <= held THEN 'val' ELSE 'train' END AS split
FROM c"""


@register("three_way_split", _THREE_SQL)
def three_way_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """60/20/20 split from one hash rank and two cut points."""
    o = fx.t(spark, sf_dir, "orders").select("o_orderkey")
    return split.three_way_split(o, "o_orderkey", 0.4, 0.5, seed=42)
