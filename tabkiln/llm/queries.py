"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.llm import (bpe, exact_topk, minhash, mixing, periodic_runs, permutation_index, rlz_dedup, sentence_pieces,
                         spelling, suffix_dedup, toxicity, url_cascade, warc)
from tabkiln.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file."""
    if importlib.util.find_spec("public_tokenizers"):
        import public_tokenizers

        return str(public_tokenizers.path(name))
    return f"/opt/tokenizers/{name}"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(table(spark, sf_dir, "documents"))


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"))


def op3_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), vocabulary())


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op7_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), (F.col("size") * F.col("copies")).alias("taken"))


def op10_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz_dedup.passage_digests(table(spark, sf_dir, "documents"))


def with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of one text in ten, by a hash of its id, the words from some place on repeat with a period.

    With g = floor(crc32(id) / 10), n words, a = g % n and p = 1 + floor((n - a) / (3 + g % 8)), word i >= a becomes
    word a + (i - a) % p.  Rows without id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    planted = (docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("w"))
               .withColumn("n", F.when(F.size("w") > 0, F.size("w")))
               .withColumn("a", (F.col("g") % F.col("n")).cast("int"))
               .withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")))
    text = F.expr("array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), "
                  "cast(ceil((n - a) / p) as int))), 1, n - a)), ' ')")
    return planted.select("doc_id", F.when(F.col("n").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(with_periods(table(spark, sf_dir, "documents")))


def with_slips(runs: DataFrame) -> DataFrame:
    """(word): every run; where 31 divides h, the crc32 of "id:run", without its code point h % length."""
    h, run = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary")), F.col("run")
    hashed = runs.select(run, h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    return hashed.select(F.when(F.col("h") % 31 == 0, F.concat(F.left(run, at), F.substring(run, at + 2, F.length(run)))).otherwise(run).alias("word"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.letter_runs(table(spark, sf_dir, "documents"), least=7)  # a run only gets shorter
    return spelling.variant_groups(spelling.count_words(with_slips(runs), least_letters=7, least_count=2), ratio=10)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentence_pieces.encode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_suffix_dedup, op2_permutation_index, op3_bbit_minhash, op4_bpe, op5_exact_topk, op6_warc, op7_url_cascade,
    op8_toxicity, op9_mixing, op10_rlz_dedup, op11_periodic_runs, op12_spelling, op13_sentencepiece, pipeline)}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_topk": """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op6_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to FROM m""",
    "op7_url_cascade": r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u),
k AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(verdict, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                              ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f AS (SELECT page_id, max({'n': length(rh || rp), 'h': length(rh), 'rule': rh || rp, 'verdict': verdict}) AS b
      FROM k JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT k.page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM k LEFT JOIN f USING (page_id)""",
    "op9_mixing": r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 6))::INT AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 3.0::DOUBLE * sum(size) AS cap,
             [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM d GROUP BY source),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
             sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS above FROM s),
l AS (SELECT max(((SELECT sum(source_size) FROM s) - below) / above) AS level FROM o),
t AS (SELECT source, source_size, least(cap, w * (SELECT level FROM l)) AS target FROM s),
t2 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
g AS (SELECT source, u // 4096 AS b, u, sum(size) AS n FROM d GROUP BY ALL),
c AS (SELECT source, b, sum(n) AS n FROM g GROUP BY ALL),
c2 AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY b) AS after FROM c),
e AS (SELECT t2.source, b, after - n AS base, target - whole * source_size AS rest FROM c2 JOIN t2 ON c2.source IS NOT DISTINCT FROM t2.source
      WHERE after - n <= target - whole * source_size AND after > target - whole * source_size),
f AS (SELECT g.source, e.b, base, rest, u, n, sum(n) OVER (PARTITION BY g.source ORDER BY u) AS after
      FROM g JOIN e ON g.source IS NOT DISTINCT FROM e.source AND g.b = e.b),
k AS (SELECT source, max(u) + 1 AS cut FROM f WHERE base + after - n / 2 <= rest GROUP BY source)
SELECT doc_id, size, t2.source_size, round(target, 3) AS target,
       (size * (whole + CASE WHEN u < coalesce(k.cut, e.b * 4096, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN t2 ON d.source IS NOT DISTINCT FROM t2.source
LEFT JOIN e ON e.source IS NOT DISTINCT FROM d.source LEFT JOIN k ON k.source IS NOT DISTINCT FROM d.source""",
    # crc32 bit by bit over the bytes' bits, lowest first; near words share what is left without one letter, at one place
    # (a letter replaced), or one of them is what is left of the other
    "op12_spelling": r"""
WITH r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS raw FROM documents),
l AS (SELECT id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM r WHERE length(raw) >= 7),
b AS (SELECT w, count(*) AS k, hex(encode(id || ':' || w)) AS x FROM l GROUP BY id, w),
c AS (SELECT w, k, 4294967295 - list_reduce(
        [4294967295::BIGINT] || [(('0x' || substr(x, 2 * (i // 8) + 1, 2))::INT >> (i % 8)::INT & 1)::BIGINT FOR i IN range(4 * len(x))],
        lambda c, t: xor(c >> 1, 3988292384 * (xor(c, t) & 1))) AS h FROM b),
o AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, k FROM c),
v AS (SELECT word, sum(k)::BIGINT AS n FROM o WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
d AS (SELECT word, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS left_over
      FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT x.word AS word, y.word AS near FROM d x JOIN d y ON x.i = y.i AND x.left_over = y.left_over AND x.word <> y.word
      UNION SELECT d.word, v.word FROM d JOIN v ON d.left_over = v.word
      UNION SELECT v.word, d.word FROM d JOIN v ON d.left_over = v.word),
s AS (SELECT p.word, count(*) AS n_near, min({'minus': -v.n, 'near': p.near}) AS best FROM p JOIN v ON v.word = p.near GROUP BY p.word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best.minus >= 10 * v.n THEN best.near END AS form,
             CASE WHEN -best.minus >= 10 * v.n THEN -best.minus END AS form_n FROM v LEFT JOIN s USING (word)),
t AS (WITH RECURSIVE t(word, root, depth) AS (
        SELECT word, word, 0 FROM f UNION ALL SELECT t.word, f.form, depth + 1 FROM t JOIN f ON f.word = t.root WHERE f.form IS NOT NULL)
      SELECT word, max_by(root, depth) AS root FROM t GROUP BY word)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM f JOIN t USING (word)""",
}
