"""A corpus in five stages, from raw documents to token ids.

Each stage works on all rows its predecessor kept and is written as Parquet
before the next one reads it.  All but the last return the columns of
``documents``; the last returns doc_id, ids and the decoded text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.llm import bpe, minhash, mixing, rlz_dedup, toxicity
from tabkiln.llm.common import materialize, table
from tabkiln.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is not rejected; a row's verdict follows its text alone."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more), each of its texts once.

    Rows without id take part under a hash of their text, from 2^62 on, so that a row with an id stays before them.
    """
    content = F.xxhash64("text").bitwiseAND(F.lit(2**62 - 1)).bitwiseOR(F.lit(2**62))
    keyed = docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), content))
    groups = minhash.near_duplicates(keyed.select("__key", "text"), id_col="__key", shingle=5, percent=80)
    gone = groups.filter(~F.col("kept")).select("__key").distinct()
    name = ["__key", F.xxhash64(F.lit(1), "text").alias("__t1"), F.xxhash64(F.lit(2), "text").alias("__t2")]
    # only the rows of keys that repeat a text are grouped, few of all
    repeated = (keyed.select(name).join(gone, "__key", "left_anti").groupBy("__key", "__t1", "__t2").agg(F.count("*").alias("__n"))
                .filter("__n > 1").select("__key").distinct())
    row = F.struct(*[c for c in COLUMNS if c != "text"])
    single = (keyed.join(repeated, "__key", "left_semi").groupBy(*name).agg(F.min(row).alias("__row"), F.first("text").alias("text"))
              .select("text", "__row.*"))
    plain = keyed.join(gone.union(repeated), "__key", "left_anti")
    return plain.select(COLUMNS).unionByName(single.select(COLUMNS))


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur again; texts with none stay as they are, to the byte."""
    return rlz_dedup.cut_texts(docs, n_chars_col="n_chars").select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it."""
    taken = mixing.mix_rows(docs)
    return taken.select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and the text they decode to."""
    return bpe.encode(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("passages", drop_passages),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL expresses neither the learned classifier nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
