"""Queries for text windows, segment aggregation and knowledge triples (steps 7 and 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.functions import binarize
from tabkiln.operators import metrics, segments, split, triples
from tabkiln.plans import fixtures as fx
from tabkiln.plans.q_metrics import _OVERALL_CTE, _SWEEP_CTE, RATES_SQL, _counts_sql
from tabkiln.plans.registry import register

LENGTH, OVERLAP = 256, 64
_SEG_SQL = fx.SEGMENTS_SQL.format(length=LENGTH, overlap=OVERLAP, step=LENGTH - OVERLAP)


def _windows(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    d = fx.t(spark, sf_dir, "documents") if docs is None else docs
    return segments.text_windows(d, "doc_id", "text", LENGTH, OVERLAP, carry=["lang"])


def _scored_segments(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    w = _windows(spark, sf_dir, docs)
    return w.withColumn("logits", fx.segment_logits(F.size("tokens"), F.col("seg_no"), F.col("doc_id")))


_WIN_SQL = f"""WITH {_SEG_SQL}
SELECT doc_id, lang, seg_no, CAST(len(seg) AS INTEGER) AS n_tokens, md5(array_to_string(seg, ' ')) AS seg_hash
FROM segments"""


@register("text_windows", _WIN_SQL)
def text_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """256-token windows with 64 overlap over whole documents (content hashed for the check)."""
    w = _windows(spark, sf_dir)
    return w.select(
        "doc_id", "lang", "seg_no", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("seg_hash")
    )


_SL_CTE = f"""{_SEG_SQL},
sl AS (SELECT doc_id, lang, seg_no,
         CAST((len(seg) % 11) - 5 AS DOUBLE) / 2.0 AS l0,
         CAST(((seg_no * 7 + doc_id) % 13) - 6 AS DOUBLE) / 2.0 AS l1
       FROM segments)"""

_MEAN_CTE = f"""{_SL_CTE},
agg_mean AS (SELECT doc_id, arg_min(lang, seg_no) AS lang, avg(l0) AS logit0, avg(l1) AS logit1,
                    count(*) AS n_segments FROM sl GROUP BY doc_id)"""

_MEAN_SQL = f"""WITH {_MEAN_CTE}
SELECT *, 1.0 / (1.0 + exp(-logit1)) AS prob FROM agg_mean"""


def _agg_out(agg: DataFrame) -> DataFrame:
    out = segments.positive_probability(agg)
    return out.select(
        "doc_id", "lang", F.col("logits")[0].alias("logit0"), F.col("logits")[1].alias("logit1"), "n_segments", "prob"
    )


@register("segment_mean", _MEAN_SQL, doubles=["logit0", "logit1", "prob"])
def segment_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element-wise mean of segment logits per document, then sigmoid of class 1."""
    agg = segments.aggregate_segments(_scored_segments(spark, sf_dir), "doc_id", "logits", "mean", n_logits=2, carry=["lang"])
    return _agg_out(agg)


_MAX_SQL = f"""WITH {_SL_CTE},
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY l1 DESC, seg_no ASC) AS rn,
             count(*) OVER (PARTITION BY doc_id) AS n_segments,
             first_value(lang) OVER (PARTITION BY doc_id ORDER BY seg_no) AS lang0 FROM sl)
SELECT doc_id, lang0 AS lang, l0 AS logit0, l1 AS logit1, n_segments, 1.0 / (1.0 + exp(-l1)) AS prob
FROM r WHERE rn = 1"""


@register("segment_max", _MAX_SQL, doubles=["logit0", "logit1", "prob"])
def segment_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logit vector of the segment with the largest class-1 logit, ties to the first."""
    agg = segments.aggregate_segments(_scored_segments(spark, sf_dir), "doc_id", "logits", "max", carry=["lang"])
    return _agg_out(agg)


_BIN_SQL = f"""WITH {_MEAN_CTE}
SELECT doc_id, 1.0 / (1.0 + exp(-logit1)) AS prob,
       CASE WHEN 1.0 / (1.0 + exp(-logit1)) > 0.5 THEN 1 ELSE 0 END AS pred
FROM agg_mean"""


@register("sigmoid_binarize", _BIN_SQL, doubles=["prob"])
def sigmoid_binarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sigmoid of the aggregated logit and a 0/1 prediction at > 0.5."""
    agg = segments.aggregate_segments(_scored_segments(spark, sf_dir), "doc_id", "logits", "mean", n_logits=2)
    out = segments.positive_probability(agg)
    return out.select("doc_id", "prob", binarize("prob", 0.5).alias("pred"))


def _doc_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document scores (mean of segment logits) with their labels; only labelled documents are windowed."""
    lab = fx.t(spark, sf_dir, "labels").select("doc_id", "quality")
    labelled = fx.t(spark, sf_dir, "documents").join(lab.select("doc_id"), "doc_id", "left_semi")
    scored = _scored_segments(spark, sf_dir, labelled)
    agg = segments.aggregate_segments(scored, "doc_id", "logits", "mean", n_logits=2, carry=["lang"])
    probs = segments.positive_probability(agg).select("doc_id", "lang", "prob")
    return probs.join(lab, "doc_id").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("id_aux"), F.col("quality").alias("labels"), "prob"
    )


_DOC_TEXT_FX = f"""{_MEAN_CTE},
text_fx AS (SELECT a.doc_id AS id, a.lang AS id_aux, l.quality AS labels, 1.0 / (1.0 + exp(-a.logit1)) AS prob
            FROM agg_mean a JOIN labels l ON l.doc_id = a.doc_id)"""

_SEG_TUNED_SQL = f"""WITH {_DOC_TEXT_FX}, {_SWEEP_CTE}, {_OVERALL_CTE}
SELECT * FROM overall"""


@register("segment_tuned_metrics", _SEG_TUNED_SQL, doubles=["accuracy", "precision", "recall", "f1"])
def segment_tuned_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text flow end to end: windows -> scores -> mean per document -> per-language tuned thresholds -> metrics."""
    return metrics.overall_metrics(_doc_probs(spark, sf_dir), "prob", "labels", "id_aux")


_SEG_REPORT_SQL = f"""WITH {_DOC_TEXT_FX}, {_SWEEP_CTE},
s AS (SELECT t.*, CASE WHEN t.prob > b.threshold THEN 1 ELSE 0 END AS pred, b.threshold AS optimal_threshold
      FROM text_fx t JOIN best b ON t.id_aux = b.id_aux),
c AS (SELECT id_aux, any_value(optimal_threshold) AS optimal_threshold, count(*) AS num_samples,
             {_counts_sql("pred", "labels")} FROM s GROUP BY id_aux),
r AS (SELECT *, {RATES_SQL} FROM c)
SELECT id_aux, num_samples, optimal_threshold, f1 AS f1_optimized, accuracy AS accuracy_optimized,
       precision AS precision_optimized, recall AS recall_optimized FROM r"""


@register(
    "segment_category_report",
    _SEG_REPORT_SQL,
    doubles=["optimal_threshold", "f1_optimized", "accuracy_optimized", "precision_optimized", "recall_optimized"],
)
def segment_category_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1/A14 on document scores aggregated from segments."""
    return metrics.category_report(_doc_probs(spark, sf_dir), "prob", "labels", "id_aux")


_GSPLIT_SQL = f"""WITH {_SEG_SQL},
d AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rk,
             count(*) OVER () AS n FROM (SELECT DISTINCT doc_id FROM segments))
SELECT s.doc_id, s.seg_no, CASE WHEN d.rk <= ceil(d.n * 0.25) THEN 'test' ELSE 'train' END AS split
FROM segments s JOIN d ON d.doc_id = s.doc_id"""


@register("segment_group_split", _GSPLIT_SQL)
def segment_group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: 75/25 split of the segment table by document, so no document straddles both sides."""
    w = _windows(spark, sf_dir).select("doc_id", "seg_no")
    docs = fx.t(spark, sf_dir, "documents").filter(F.col("text").isNotNull())
    return split.split_by_group(w, "doc_id", 0.25, seed=42, groups=docs).select("doc_id", "seg_no", "split")


_CHUNK_SQL = f"""WITH {fx.SEGMENTS_SQL.format(length=256, overlap=0, step=256)}
SELECT doc_id, seg_no AS chunk_no, md5(array_to_string(seg, ' ')) AS chunk_hash FROM segments"""


@register("chunk_documents", _CHUNK_SQL)
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: whole documents cut into 256-token chunks without overlap."""
    d = fx.t(spark, sf_dir, "documents")
    c = segments.chunk_documents(d, "doc_id", "text", 256)
    return c.select("doc_id", "chunk_no", F.md5("chunk_text").alias("chunk_hash"))


# --------------------------------------------------------------------------
# triples
# --------------------------------------------------------------------------

def tagged_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged text per region (nations it contains) and per supplier (its nation).

    ``chunk_id`` is the region key for regions and 1000000 + the supplier key
    for suppliers; special tokens are included so that parsing strips them.
    """
    r = fx.t(spark, sf_dir, "region")
    n = fx.t(spark, sf_dir, "nation")
    s = fx.t(spark, sf_dir, "supplier")
    rn = r.join(n, r["r_regionkey"] == n["n_regionkey"]).groupBy("r_regionkey", "r_name").agg(
        F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("ns")
    )
    region_text = F.concat(
        F.lit("<s><triplet> "),
        F.col("r_name"),
        F.array_join(F.transform("ns", lambda x: F.concat(F.lit(" <subj> "), x["n_name"], F.lit(" <obj> contains"))), ""),
        F.lit("</s>"),
    )
    regions = rn.select(F.col("r_regionkey").cast("long").alias("chunk_id"), region_text.alias("text"))
    sn = s.join(n, s["s_nationkey"] == n["n_nationkey"])
    supp_text = F.concat(F.lit("<s><triplet> "), F.col("s_name"), F.lit(" <subj> "), F.col("n_name"), F.lit(" <obj> located in</s><pad><pad>"))
    supps = sn.select((F.col("s_suppkey") + 1000000).cast("long").alias("chunk_id"), supp_text.alias("text"))
    return regions.unionByName(supps)


# The per-region text holds a nation list of bounded size (nations per region).
_TAGGED_SQL = """tagged AS (
  SELECT CAST(r.r_regionkey AS BIGINT) AS chunk_id,
         '<s><triplet> ' || r.r_name || string_agg(' <subj> ' || n.n_name || ' <obj> contains', '' ORDER BY n.n_nationkey) || '</s>' AS text
  FROM region r JOIN nation n ON r.r_regionkey = n.n_regionkey GROUP BY r.r_regionkey, r.r_name
  UNION ALL
  SELECT CAST(s.s_suppkey + 1000000 AS BIGINT),
         '<s><triplet> ' || s.s_name || ' <subj> ' || n.n_name || ' <obj> located in</s><pad><pad>'
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)"""

_TRIPLES_CTE = f"""{_TAGGED_SQL},
tk AS (SELECT chunk_id, ' ' || array_to_string(list_filter(
          string_split_regex(regexp_replace(text, '<s>|<pad>|</s>', '', 'g'), '[ \\t\\n\\r]+'), lambda x: x <> ''), ' ') || ' ' AS norm
       FROM tagged),
pa AS (SELECT chunk_id, string_split(norm, ' <triplet> ') AS parts FROM tk),
pe AS (SELECT chunk_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS p, len(parts) AS np FROM pa),
sa AS (SELECT chunk_id, p, np, string_split(' ' || part || ' ', ' <subj> ') AS segs FROM pe WHERE p > 1),
se AS (SELECT chunk_id, p, np, trim(segs[1]) AS head, unnest(segs) AS seg, generate_subscripts(segs, 1) AS s,
              len(segs) AS ns FROM sa),
tr AS (SELECT chunk_id, head,
         CASE WHEN instr(' ' || seg || ' ', ' <obj> ') > 0
              THEN trim(split_part(' ' || seg || ' ', ' <obj> ', -1)) ELSE '' END AS relation,
         trim(split_part(' ' || seg || ' ', ' <obj> ', 1)) AS tail,
         (p = np AND s = ns) AS is_last
       FROM se WHERE s > 1),
triples AS (SELECT chunk_id, head, relation, tail FROM tr
            WHERE relation <> '' AND (NOT is_last OR (head <> '' AND tail <> '')))"""

_TRIPLES_SQL = f"WITH {_TRIPLES_CTE}\nSELECT * FROM triples"


def _triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples.triples_from_tags(tagged_chunks(spark, sf_dir), "chunk_id", "text")


@register("triples_from_tags", _TRIPLES_SQL)
def triples_from_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: (head, relation, tail) triples parsed from tagged text, special tokens stripped."""
    return _triples(spark, sf_dir)


def query_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.t(spark, sf_dir, "supplier")
    r = fx.t(spark, sf_dir, "region")
    q1 = s.select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("query_id"),
        F.concat(F.lit("Where is "), F.col("s_name"), F.lit(" located?")).alias("query"),
    )
    q2 = r.select(
        F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("query_id"),
        F.concat(F.lit("What does "), F.col("r_name"), F.lit(" contain?")).alias("query"),
    )
    return q1.unionByName(q2)


# a subject matches where its words stand next to each other in the query
_STOP_SQL = ", ".join(f"'{w}'" for w in triples.STOPWORDS)
_LOOKUP_SQL = f"""WITH {_TRIPLES_CTE},
q AS (SELECT 's' || CAST(s_suppkey AS VARCHAR) AS query_id, 'Where is ' || s_name || ' located?' AS query FROM supplier
      UNION ALL
      SELECT 'r' || CAST(r_regionkey AS VARCHAR), 'What does ' || r_name || ' contain?' FROM region),
qn AS (SELECT query_id, trim(regexp_replace(lower(query), '[^a-z0-9_#]+', ' ', 'g')) AS norm FROM q),
tn AS (SELECT *, trim(regexp_replace(lower(head), '[^a-z0-9_#]+', ' ', 'g')) AS keyword FROM triples)
SELECT qn.query_id, t.keyword, t.chunk_id, t.head, t.relation, t.tail, md5(tg.text) AS chunk_hash
FROM qn JOIN tn t ON contains(' ' || qn.norm || ' ', ' ' || t.keyword || ' ')
LEFT JOIN tagged tg ON tg.chunk_id = t.chunk_id
WHERE len(list_filter(string_split(t.keyword, ' '), lambda w: w <> '' AND w NOT IN ({_STOP_SQL}))) > 0"""


@register("triple_lookup", _LOOKUP_SQL)
def triple_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects of several words found in query texts, with the source chunk carried along."""
    chunks = tagged_chunks(spark, sf_dir).withColumn("chunk_hash", F.md5("text"))
    found = triples.triples_from_tags(chunks, "chunk_id", "text", carry=["chunk_hash"])
    hits = triples.lookup_triples(query_texts(spark, sf_dir), "query_id", "query", found)
    return hits.select("query_id", "keyword", "chunk_id", "head", "relation", "tail", "chunk_hash")


_DEGREE_SQL = f"""WITH {_TRIPLES_CTE},
ends AS (SELECT head AS node, 1 AS o, 0 AS i FROM triples UNION ALL SELECT tail, 0, 1 FROM triples)
SELECT node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM ends GROUP BY node"""


@register("graph_degrees", _DEGREE_SQL)
def graph_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: directed graph of the triples as vertex degrees."""
    return triples.graph_degrees(_triples(spark, sf_dir))


_VERT_SQL = f"""WITH {_TRIPLES_CTE}
SELECT head AS node FROM triples UNION SELECT tail FROM triples"""


@register("graph_vertices", _VERT_SQL)
def graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: distinct vertices of the triple graph."""
    return triples.graph_vertices(_triples(spark, sf_dir))


_EDGE_SQL = f"""WITH {_TRIPLES_CTE}
SELECT head AS src, tail AS dst, relation FROM triples"""


@register("graph_edges", _EDGE_SQL)
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: directed edges of the triple graph."""
    return triples.graph_edges(_triples(spark, sf_dir))
