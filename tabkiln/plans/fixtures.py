"""Inputs derived from the driver tables.

Each fixture has a Spark derivation and the equivalent DuckDB SQL, written
next to each other so that both sides build the same rows.  All derivations
are deterministic arithmetic on the keys, so they grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.sources import load_table


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, sf_dir, name)


# --------------------------------------------------------------------------
# reg: regression table built from orders (planted collinear, constant,
# categorical and nullable columns)
# --------------------------------------------------------------------------

def reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    y = F.col("o_totalprice") / 1000.0
    x1 = y * 2.0 + (k % 3).cast("double")
    x3 = (k % 97).cast("double")
    return o.select(
        k.alias("id"),
        y.alias("y"),
        x1.alias("x1"),
        (x1 * 1.01).alias("x2"),
        x3.alias("x3"),
        (k % 5).cast("int").alias("c1"),
        F.lit(7.0).alias("k"),
        F.when(k % 4 != 0, x3).alias("n1"),
        F.when((k % 2 == 0) & (k % 5 != 0), x1).alias("n2"),
    )


REG_SQL = """reg AS (
  SELECT o_orderkey AS id,
         o_totalprice / 1000.0 AS y,
         (o_totalprice / 1000.0) * 2.0 + CAST(o_orderkey % 3 AS DOUBLE) AS x1,
         ((o_totalprice / 1000.0) * 2.0 + CAST(o_orderkey % 3 AS DOUBLE)) * 1.01 AS x2,
         CAST(o_orderkey % 97 AS DOUBLE) AS x3,
         CAST(o_orderkey % 5 AS INTEGER) AS c1,
         7.0::DOUBLE AS k,
         CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 97 AS DOUBLE) END AS n1,
         CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0
              THEN (o_totalprice / 1000.0) * 2.0 + CAST(o_orderkey % 3 AS DOUBLE) END AS n2
  FROM orders)"""


# --------------------------------------------------------------------------
# preds: two model prediction tables and the truth table, from orders
# --------------------------------------------------------------------------

def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 1000.0).alias("y"))


def pred_a(spark: SparkSession, sf_dir: str, drop_every: int | None = None) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    out = o.select(
        k.alias("id"),
        (F.col("o_totalprice") / 1000.0 + ((k % 7) - 3).cast("double") * 1.4).alias("y_pred_a"),
    )
    return out if drop_every is None else out.filter(F.col("id") % drop_every != 0)


def pred_b(spark: SparkSession, sf_dir: str, drop_every: int | None = None) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    out = o.select(
        k.alias("id"),
        (F.col("o_totalprice") / 1000.0 + ((k % 5) - 2).cast("double") * 2.0).alias("y_pred_b"),
    )
    return out if drop_every is None else out.filter(F.col("id") % drop_every != 0)


TRUTH_SQL = "truth AS (SELECT o_orderkey AS id, o_totalprice / 1000.0 AS y FROM orders)"
PRED_A_SQL = (
    "pred_a AS (SELECT o_orderkey AS id, "
    "o_totalprice / 1000.0 + CAST((o_orderkey % 7) - 3 AS DOUBLE) * 1.4::DOUBLE AS y_pred_a FROM orders{where})"
)
PRED_B_SQL = (
    "pred_b AS (SELECT o_orderkey AS id, "
    "o_totalprice / 1000.0 + CAST((o_orderkey % 5) - 2 AS DOUBLE) * 2.0::DOUBLE AS y_pred_b FROM orders{where})"
)


# --------------------------------------------------------------------------
# nullable: documents LEFT JOIN labels (natural NULLs in quality, toxic)
# --------------------------------------------------------------------------

def nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = t(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left")


NULLABLE_SQL = """nullable AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


# --------------------------------------------------------------------------
# text: labelled documents with a planted probability
# --------------------------------------------------------------------------

def text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    lab = t(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id", "inner")
    return j.select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("id_aux"),
        F.col("text").alias("main_info"),
        F.col("quality").alias("labels"),
        (((F.col("doc_id") * 37) % 101).cast("double") / 101.0 * 0.6 + F.col("quality").cast("double") * 0.3).alias(
            "prob"
        ),
    )


TEXT_SQL = """text_fx AS (
  SELECT d.doc_id AS id, d.lang AS id_aux, d.text AS main_info, l.quality AS labels,
         CAST((d.doc_id * 37) % 101 AS DOUBLE) / 101.0 * 0.6 + CAST(l.quality AS DOUBLE) * 0.3 AS prob
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


# --------------------------------------------------------------------------
# segments: whitespace windows of 256 tokens with overlap 64, planted logits
# --------------------------------------------------------------------------

def segment_logits(seg_len: F.Column, seg_no: F.Column, doc_id: F.Column) -> F.Column:
    return F.array(
        ((seg_len % 11) - 5).cast("double") / 2.0,
        (((seg_no * 7 + doc_id) % 13) - 6).cast("double") / 2.0,
    )


# Window start offsets: 0, step, 2*step, ... while the previous window does not
# already reach the end; one window when the text fits.
SEGMENTS_SQL = """seg_base AS (
  SELECT doc_id, lang, text,
         list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda x: x <> '') AS toks
  FROM documents),
seg_starts AS (
  SELECT doc_id, lang, toks, unnest(range(0, greatest(len(toks) - {overlap}, 1), {step})) AS start
  FROM seg_base),
segments AS (
  SELECT doc_id, lang,
         CAST(start // {step} AS INTEGER) AS seg_no,
         toks[start + 1 : start + {length}] AS seg
  FROM seg_starts)"""


# --------------------------------------------------------------------------
# hier: hierarchical multi-label scores from embeddings
# main logits = 10 embedding elements * 10, y_i = (label = i)
# sub logits  = 30 embedding elements * 10 as 10 x 3, y_ij = (label = i AND vec_id % 3 = j)
# --------------------------------------------------------------------------

N_MAIN = 10
N_SUB = 3


def hier_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long table ``(id, level, kind, label_idx, label_name, logit, y)``.

    level 1 uses elements 1-40 of the embedding, level 2 elements 41-64 plus
    1-16 (wrapping), so both levels carry real data from the table.  All
    (level, kind) blocks come from one scan and one explode.
    """
    e = t(spark, sf_dir, "embeddings")
    blocks = []
    for level, base in ((1, 0), (2, 40)):
        main = F.transform(
            F.sequence(F.lit(0), F.lit(N_MAIN - 1)),
            lambda i: F.struct(
                F.lit(level).alias("level"),
                F.lit("main").alias("kind"),
                i.alias("label_idx"),
                (F.element_at("embedding", ((i + base) % 64) + 1).cast("double") * 10.0).alias("logit"),
                (F.col("label") == i).cast("int").alias("y"),
            ),
        )
        sub = F.transform(
            F.sequence(F.lit(0), F.lit(N_MAIN * N_SUB - 1)),
            lambda i: F.struct(
                F.lit(level).alias("level"),
                F.lit("sub").alias("kind"),
                i.alias("label_idx"),
                (F.element_at("embedding", ((i + base + N_MAIN) % 64) + 1).cast("double") * 10.0).alias("logit"),
                ((F.col("label") == F.floor(i / N_SUB)) & ((F.col("vec_id") % N_SUB) == (i % N_SUB)))
                .cast("int")
                .alias("y"),
            ),
        )
        blocks += [main, sub]
    out = e.select(F.col("vec_id").alias("id"), F.explode(F.concat(*blocks)).alias("s"))
    name = F.when(
        F.col("s.kind") == "main", F.concat(F.lit("Main_"), F.col("s.label_idx").cast("string"))
    ).otherwise(
        F.concat(
            F.lit("Main_"),
            F.floor(F.col("s.label_idx") / N_SUB).cast("string"),
            F.lit("_Sub_"),
            (F.col("s.label_idx") % N_SUB).cast("string"),
        )
    )
    return out.select(
        "id",
        F.col("s.level").alias("level"),
        F.col("s.kind").alias("kind"),
        F.col("s.label_idx").alias("label_idx"),
        name.alias("label_name"),
        F.col("s.logit").alias("logit"),
        F.col("s.y").alias("y"),
    )


HIER_SQL = """hier_src AS (
  SELECT vec_id, label, embedding, lvl.level, lvl.base FROM embeddings,
         (VALUES (1, 0), (2, 40)) AS lvl(level, base)),
hier_main AS (
  SELECT vec_id AS id, level, 'main' AS kind, i AS label_idx,
         'Main_' || CAST(i AS VARCHAR) AS label_name,
         CAST(embedding[((i + base) % 64) + 1] AS DOUBLE) * 10.0 AS logit,
         CAST(label = i AS INTEGER) AS y
  FROM hier_src, range(0, 10) r(i)),
hier_sub AS (
  SELECT vec_id AS id, level, 'sub' AS kind, i AS label_idx,
         'Main_' || CAST(i // 3 AS VARCHAR) || '_Sub_' || CAST(i % 3 AS VARCHAR) AS label_name,
         CAST(embedding[((i + base + 10) % 64) + 1] AS DOUBLE) * 10.0 AS logit,
         CAST(label = i // 3 AND vec_id % 3 = i % 3 AS INTEGER) AS y
  FROM hier_src, range(0, 30) r(i)),
hier AS (
  SELECT id, level, kind, CAST(label_idx AS INTEGER) AS label_idx, label_name, logit, y FROM hier_main
  UNION ALL
  SELECT id, level, kind, CAST(label_idx AS INTEGER) AS label_idx, label_name, logit, y FROM hier_sub)"""


# --------------------------------------------------------------------------
# ordered: events with a planted nullable value for fills
# --------------------------------------------------------------------------

def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events")
    return e.select("event_id", "user_id", F.when(F.col("event_id") % 4 == 0, F.col("value")).alias("v"))


ORDERED_SQL = """ordered AS (
  SELECT event_id, user_id, CASE WHEN event_id % 4 = 0 THEN value END AS v FROM events)"""
