"""Queries for wide tables: blocked correlations, wide PCA, sparse one-hot, target statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.operators import blocked, encode, reduce, target_stats
from tabkiln.plans import fixtures as fx
from tabkiln.plans.registry import register

# 64 elements of a vector as columns; a third of them has gaps, and eight more
# columns are near copies of the first eight.
_D, _COPIES, _TILE = 64, 8, 20
_NAMES = [f"e{i}" for i in range(_D)] + [f"copy{i}" for i in range(_COPIES)]


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.t(spark, sf_dir, "embeddings")
    cell = {i: F.get("embedding", F.lit(i)).cast("double") for i in range(_D)}
    gap = {i: F.when((F.col("vec_id") + i) % 7 != 0, cell[i]) if i % 3 == 0 else cell[i] for i in range(_D)}
    return e.select(
        "vec_id",
        *[gap[i].alias(f"e{i}") for i in range(_D)],
        *[(cell[i] * 3 + (F.col("vec_id") % 2) * 0.001).alias(f"copy{i}") for i in range(_COPIES)],
    )


_WIDE_LONG = f"""el AS (SELECT vec_id, unnest(range({_D})) AS i, embedding FROM embeddings),
cells AS (
  SELECT vec_id, i AS pos, 'e' || i AS name,
         CASE WHEN i % 3 <> 0 OR (vec_id + i) % 7 <> 0 THEN CAST(embedding[i + 1] AS DOUBLE) END AS x FROM el
  UNION ALL
  SELECT vec_id, i + {_D}, 'copy' || i, CAST(embedding[i + 1] AS DOUBLE) * 3 + (vec_id % 2) * 0.001::DOUBLE FROM el WHERE i < {_COPIES}),
pairs AS (
  SELECT a.name AS col_a, b.name AS col_b, CAST(a.pos AS INTEGER) AS pos_a, CAST(b.pos AS INTEGER) AS pos_b, corr(a.x, b.x) AS corr
  FROM cells a JOIN cells b ON a.vec_id = b.vec_id AND a.pos < b.pos
  GROUP BY ALL)"""


@register("corr_blocked", f"WITH {_WIDE_LONG}\nSELECT * FROM pairs", doubles=["corr"])
def corr_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: every pair of 72 columns with gaps, in tiles of 20 x 20 columns."""
    return blocked.blocked_pairs(_wide(spark, sf_dir), _NAMES, tile=_TILE)


_DROP_SQL = f"""WITH {_WIDE_LONG},
dropped AS (SELECT DISTINCT col_b FROM pairs WHERE abs(corr) > 0.95 AND col_b <> 'copy5')
SELECT vec_id, {", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) * 3 + (vec_id % 2) * 0.001::DOUBLE AS copy{i}" for i in [5])},
       (SELECT count(*) FROM dropped) AS n_dropped
FROM embeddings"""


@register("remove_collinear_blocked", _DROP_SQL, doubles=["copy5"])
def remove_collinear_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among 72 columns go, but the one to keep; only pairs above the threshold are read."""
    wide = _wide(spark, sf_dir)
    left = blocked.remove_collinear(wide, _NAMES, 0.95, keep=["copy5"], tile=_TILE)
    copies = [c for c in left.columns if c.startswith("copy")]
    return left.select("vec_id", *copies, F.lit(len(wide.columns) - len(left.columns)).cast("long").alias("n_dropped"))


# 48 columns made of two by an orthogonal design of 48: sums, differences and the two themselves
_MIX = [("x + z", 1, 1), ("x - z", 1, -1), ("x", 1, 0), ("z", 0, 1)]
_PCA_SQL = f"""WITH {fx.REG_SQL},
c AS (SELECT avg(x1) AS ma, avg(x3) AS mb, var_samp(x1) AS a, var_samp(x3) AS d, covar_samp(x1, x3) AS b FROM reg),
l AS (SELECT *, (a + d) / 2 + sqrt(power((a - d) / 2, 2) + b * b) AS l1 FROM c),
v AS (SELECT *, sqrt(b * b + power(l1 - a, 2)) AS len FROM l)
SELECT id, 0.006 * abs(((x1 - ma) * b + (x3 - mb) * (l1 - a)) / len) AS pca_0,
       0.006 * abs(((x1 - ma) * (l1 - a) - (x3 - mb) * b) / len) AS pca_1,
       l1 / (a + d) AS explained_0
FROM reg, v"""


@register("pca_wide", _PCA_SQL, doubles=["pca_0", "pca_1", "explained_0"])
def pca_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: 48 columns that are twelve times x+z, x-z, x and z; their components, in thousands, are 0.006 times those of x and z (signs apart)."""
    r = fx.reg(spark, sf_dir)
    cols = {f"m{i}": F.col("x1") * a + F.col("x3") * b for i, (_, a, b) in enumerate(_MIX * 12)}
    wide = r.select("id", *[x.alias(n) for n, x in cols.items()])
    model = reduce.fit_pca_wide(wide, list(cols), 2)
    out = model.transform(wide, keep=["id"])
    share = F.lit(model.explained_variance[0]).alias("explained_0")
    return out.select("id", *[(F.abs(c) / 1000).alias(c) for c in ("pca_0", "pca_1")], share)


_SPARSE_COLS = ["l_partkey", "l_suppkey", "l_returnflag"]
_SPARSE_SQL = f"""WITH pairs AS (
{" UNION ".join(f"SELECT {i} AS pos, lower(trim(CAST({c} AS VARCHAR))) AS v FROM lineitem" for i, c in enumerate(_SPARSE_COLS))}),
d AS (SELECT pos, v, CAST(row_number() OVER (ORDER BY pos, v) - 1 AS INTEGER) AS idx, count(*) OVER () AS size FROM pairs)
SELECT l_orderkey, l_linenumber, [{", ".join(f"d{i}.idx" for i in range(len(_SPARSE_COLS)))}] AS onehot, d0.size AS size
FROM lineitem
{" ".join(f"JOIN d d{i} ON d{i}.pos = {i} AND d{i}.v = lower(trim(CAST({c} AS VARCHAR)))" for i, c in enumerate(_SPARSE_COLS))}"""


@register("onehot_sparse", _SPARSE_SQL)
def onehot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dummies of columns with thousands of values, as positions of a wide vector."""
    lines = fx.t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_SPARSE_COLS)
    model = encode.fit_onehot_sparse(lines, _SPARSE_COLS)
    return model.transform(lines).withColumn("size", F.lit(model.size).cast("long"))


_TS_SQL = """WITH e AS (
  SELECT event_id, CASE WHEN user_id % 5 <> 0 THEN user_id % 3 END AS grp,
         CASE WHEN event_id % 11 <> 0 THEN value END AS y FROM events),
p AS (SELECT avg(y) AS prior FROM e)
SELECT event_id, grp,
  (coalesce(sum(y) OVER w, 0) + 2 * prior) / (count(y) OVER w + 2) AS grp_stat
FROM e, p
WINDOW w AS (PARTITION BY grp ORDER BY md5('7:' || event_id), event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def _grouped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.t(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.when(F.col("user_id") % 5 != 0, F.col("user_id") % 3).alias("grp"),
        F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("y"),
    )


@register("ordered_target_stats", _TS_SQL, doubles=["grp_stat"])
def ordered_target_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: mean label of the earlier rows of a category in a seeded order; four hot categories over many ranges."""
    events = _grouped_events(spark, sf_dir)
    return target_stats.ordered_target_stats(events, "grp", "y", "event_id", seed=7, weight=2.0, rows_per_bucket=2_000).drop("y")


_TT_SQL = """WITH e AS (
  SELECT event_id, CASE WHEN user_id % 5 <> 0 THEN user_id % 3 END AS grp,
         CASE WHEN event_id % 11 <> 0 THEN value END AS y FROM events),
p AS (SELECT avg(y) AS prior FROM e WHERE event_id % 4 <> 0),
s AS (SELECT grp, coalesce(sum(y), 0) AS total, count(y) AS n FROM e WHERE event_id % 4 <> 0 GROUP BY grp)
SELECT t.event_id, t.grp, CASE WHEN t.event_id % 8 = 0 THEN 99 ELSE t.grp END AS seen,
       (coalesce(total, 0) + prior) / (coalesce(n, 0) + 1) AS grp_stat
FROM e t CROSS JOIN p LEFT JOIN s ON s.grp IS NOT DISTINCT FROM CASE WHEN t.event_id % 8 = 0 THEN 99 ELSE t.grp END
WHERE t.event_id % 4 = 0"""


@register("target_stats_scored", _TT_SQL, doubles=["grp_stat"])
def target_stats_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: held-out rows scored by the whole training table; half of them carry a category not seen there."""
    events = _grouped_events(spark, sf_dir)
    train, test = events.filter("event_id % 4 <> 0"), events.filter("event_id % 4 = 0")
    seen = test.withColumn("seen", F.when(F.col("event_id") % 8 == 0, F.lit(99).cast("long")).otherwise(F.col("grp")))
    model = target_stats.fit_target_stats(train.withColumnRenamed("grp", "seen"), "seen", "y")
    return model.transform(seen, "grp_stat").select("event_id", "grp", "seen", "grp_stat")
