"""Knowledge triples: parse tagged text, look triples up by keyword, graph view.

The tagged format is ``<triplet> head <subj> tail <obj> relation`` with any
number of ``<subj> tail <obj> relation`` pairs per ``<triplet>``.  Parsing is
done with string and array functions on whitespace-normalised text, so it
runs inside the JVM on every row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.functions import tokens

# fixed values: special tokens removed before parsing, and the markers
SPECIAL_TOKENS = ("<s>", "<pad>", "</s>")
TRIPLET, SUBJ, OBJ = "<triplet>", "<subj>", "<obj>"

# default words dropped from query texts before the subject lookup (a parameter)
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "did", "do", "does", "for", "from",
    "how", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "were", "what",
    "when", "where", "which", "who", "why", "with",
)

TRIPLE_SCHEMA = "chunk_id long, head string, relation string, tail string"


def _spaced(c: Column) -> Column:
    return F.concat(F.lit(" "), c, F.lit(" "))


def triples_from_tags(df: DataFrame, key: str, tagged: str, carry: Sequence[str] = ()) -> DataFrame:
    """``(key, carry..., head, relation, tail)`` from tagged text (K2).

    A pair is emitted when its relation is non-empty; the last pair of a text
    also needs a head and a tail.  Marker tokens count only as whole
    whitespace-separated tokens.
    """
    cleaned = F.regexp_replace(F.col(tagged), "|".join(SPECIAL_TOKENS), "")
    norm = _spaced(F.array_join(tokens(cleaned), " "))
    parts = F.split(norm, f" {TRIPLET} ")

    def pairs(part: Column, last_part: Column) -> Column:
        """Pairs of one part; its pieces are cut once, beside an explode they would be cut again for every row."""
        def of(segs: Column) -> Column:
            def pair(seg: Column, i: Column) -> Column:
                return F.struct(
                    F.trim(F.element_at(segs, 1)).alias("head"),
                    F.when(F.instr(seg, f" {OBJ} ") > 0, F.trim(F.substring_index(seg, f" {OBJ} ", -1)))
                    .otherwise(F.lit("")).alias("relation"),
                    F.trim(F.substring_index(seg, f" {OBJ} ", 1)).alias("tail"),
                    (last_part & (i == F.size(segs) - 2)).alias("last"),
                )

            # what comes before the first <subj> is the head
            return F.transform(F.transform(F.slice(segs, 2, F.size(segs)), _spaced), pair)

        return F.element_at(F.transform(F.array(F.split(_spaced(part), f" {SUBJ} ")), of), 1)

    def of_text(parts: Column) -> Column:
        # words before the first <triplet> belong to no triple
        return F.flatten(F.transform(F.slice(parts, 2, F.size(parts)), lambda part, i: pairs(part, i == F.size(parts) - 2)))

    found = F.element_at(F.transform(F.array(parts), of_text), 1)
    t = df.select(key, *carry, F.explode(found).alias("_t"))
    keep = (F.col("_t.relation") != "") & (~F.col("_t.last") | ((F.col("_t.head") != "") & (F.col("_t.tail") != "")))
    return t.filter(keep).select(key, *carry, "_t.head", "_t.relation", "_t.tail")


def extract_with(df: DataFrame, fn: Callable, schema: str = TRIPLE_SCHEMA) -> DataFrame:
    """Pluggable extractor over chunks (K3): ``fn`` maps pandas batches to triple batches."""
    return df.mapInPandas(fn, schema)


def _words(c: str) -> Column:
    return F.array_remove(F.split(F.lower(F.col(c)), "[^a-z0-9_#]+"), "")


def query_keywords(
    df: DataFrame, key: str, text: str, stopwords: Sequence[str] = STOPWORDS, max_words: int = 1
) -> DataFrame:
    """``(key, keyword)``: distinct runs of 1 to ``max_words`` lower-case words of a query, joined by one space.

    Runs of stopwords only are left out.
    """
    staged = df.select(key, _words(text).alias("_w")).filter(F.size("_w") > 0)
    n = F.size("_w")
    runs = F.flatten(
        F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(max_words), n - i + 1)), lambda k: F.slice(F.col("_w"), i, k)
            ),
        )
    )
    stop = F.array(*[F.lit(w) for w in stopwords]).cast("array<string>")
    return (
        staged.select(key, F.explode(runs).alias("_run"))
        .filter(F.size(F.array_except("_run", stop)) > 0)
        .select(key, F.array_join("_run", " ").alias("keyword"))
        .distinct()
    )


def lookup_triples(
    queries: DataFrame,
    query_key: str,
    query_text: str,
    triples: DataFrame,
    stopwords: Sequence[str] = STOPWORDS,
    max_words: int | None = None,
) -> DataFrame:
    """Triples whose subject occurs in a query as a run of its words, with the columns they carry.

    Every subject is posted under one of its words, the one that the fewest
    queries hold; a query is a candidate for the subjects posted under its
    words, and is searched for each as a phrase.  So a query yields as many rows
    as it has words, however long the subjects are.  Subjects of stopwords only
    find nothing; ``max_words`` leaves longer subjects out.
    """
    t = triples.withColumn("_head_key", F.array_join(_words("head"), " "))
    stop = F.array(*[F.lit(w) for w in stopwords]).cast("array<string>")
    subjects = t.select(F.col("_head_key").alias("keyword")).distinct().withColumn("_w", F.split("keyword", " "))
    subjects = subjects.filter(F.size(F.array_except("_w", F.array_union(stop, F.array(F.lit(""))))) > 0)
    if max_words is not None:
        subjects = subjects.filter(F.size("_w") <= max_words)
    lines = queries.select(query_key, _words(query_text).alias("_w"))
    postings = lines.select(query_key, F.explode(F.array_distinct("_w")).alias("_word"))
    held = postings.groupBy("_word").agg(F.count(F.lit(1)).alias("_held"))
    # a subject with a word that no query holds finds nothing: the inner join leaves fewer words than it has
    member = subjects.select("keyword", F.explode(F.array_distinct("_w")).alias("_word"), F.size(F.array_distinct("_w")).alias("_n"))
    anchors = (
        member.join(held, "_word")
        .groupBy("keyword", "_n")
        .agg(F.count(F.lit(1)).alias("_known"), F.min(F.struct("_held", "_word")).alias("_rarest"))
        .filter("_known = _n")
        .select("keyword", F.col("_rarest._word").alias("_word"))
    )
    candidates = postings.join(anchors, "_word").select(query_key, "keyword").distinct()
    text = lines.select(query_key, _spaced(F.array_join("_w", " ")).alias("_line"))
    hits = candidates.join(text, query_key).filter(F.contains("_line", _spaced(F.col("keyword")))).select(query_key, "keyword").distinct()
    return hits.join(t, hits["keyword"] == t["_head_key"], "inner").drop("_head_key")


def graph_edges(triples: DataFrame) -> DataFrame:
    """Directed edges ``(src, dst, relation)`` (K5)."""
    return triples.select(F.col("head").alias("src"), F.col("tail").alias("dst"), "relation")


def graph_vertices(triples: DataFrame) -> DataFrame:
    """Distinct vertices of the triple graph (K5)."""
    return triples.select(F.explode(F.array("head", "tail")).alias("node")).distinct()


def graph_degrees(triples: DataFrame) -> DataFrame:
    """``(node, out_degree, in_degree)`` in one aggregation over one pass of the edge list (K5)."""
    out_end = F.struct(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"))
    in_end = F.struct(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"))
    ends = graph_edges(triples).select(F.inline(F.array(out_end, in_end)))
    return ends.groupBy("node").agg(F.sum("o").cast("long").alias("out_degree"), F.sum("i").cast("long").alias("in_degree"))
