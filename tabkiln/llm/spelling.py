"""Groups of spelling variants by PartEnum signatures.

A word's letter multiset is a binary vector: one dimension for every letter
and occurrence ("the second e").  Two words one edit apart have vectors at
Hamming distance two (a letter replaced) or one (a letter more or less).  The
dimensions are dealt into parts by a hash.  Of ``n`` parts two vectors at
distance k differ in at most k, so they agree on all the others: a word has
one signature for each way to leave out k parts, and words with a common
signature are candidates.  Pairs of one length take ``SAME_PARTS`` parts and
leave out two, pairs of two lengths ``CROSS_PARTS`` parts and leave out one.

A multiset says nothing of the order of letters, so a signature also holds
half of the word: with m letters in the shorter one, two words one edit apart
share their first floor(m / 2) or their last ceil(m / 2) letters.  Signatures
are joined by equality; every candidate is verified by its edit distance.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.common import materialize

SAME_PARTS, CROSS_PARTS = 4, 3


def letter_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 1) -> DataFrame:
    """(id, run): every maximal run of at least ``least`` letters A-Z, a-z and U+00C0-U+00FF of whole texts, A-Z lower-cased.

    NULL texts have no runs.
    """
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{least},}}"), F.lit(0))
    run = F.col("run")
    lower = F.translate(run, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (df.select(F.col(id_col).alias("id"), F.explode(runs).alias("run"))
            .select(F.col("id").alias(id_col), F.when(F.lower(run) == run, run).otherwise(lower).alias("run")))


def count_words(words: DataFrame, least_letters: int = 7, least_count: int = 2) -> DataFrame:
    """(word, n) of the words of ``words`` that are long and frequent enough."""
    return (words.filter(F.length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= least_count))


def _dimensions() -> Column:
    """Hashes of a word's dimensions, sorted: (letter, how many of the same come before it)."""
    return F.expr("array_sort(transform(letters, (c, i) -> xxhash64(c, i - array_position(letters, c))))")


def _part(parts: int, i: int) -> Column:
    return F.xxhash64(F.expr(f"filter(dims, d -> pmod(d, {parts}) = {i})"))


def _signatures(tag: int, parts: int, left_out: int, m: Column) -> list[Column]:
    """One hash for every way to leave out parts, with the first and with the last half of a word of ``m`` letters."""
    word, half = F.col("word"), F.floor(m / 2).cast("int")
    halves = [(1, F.left(word, half)), (2, F.right(word, m - half))]
    return [F.xxhash64(F.lit(tag), m, F.lit(",".join(map(str, kept))), F.lit(side), text, *[F.col(f"p{parts}_{i}") for i in kept])
            for kept in combinations(range(parts), parts - left_out) for side, text in halves]


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): the pairs of ``words`` (word) with one code point inserted, deleted or replaced; each pair once.

    ``words`` are distinct.  In a pair a is the shorter word, or the smaller one of the same length.
    """
    parts = [_part(n, i).alias(f"p{n}_{i}") for n in (SAME_PARTS, CROSS_PARTS) for i in range(n)]
    vectors = (words.select("word", F.array_sort(F.split("word", "")).alias("letters"))
               .withColumn("dims", _dimensions()).select("word", *parts, F.length("word").alias("m")))
    same = _signatures(1, SAME_PARTS, 2, F.col("m"))
    cross = _signatures(2, CROSS_PARTS, 1, F.col("m"))
    longer = _signatures(2, CROSS_PARTS, 1, F.col("m") - 1)
    left = vectors.select("word", F.explode(F.array(*same, *cross)).alias("sig")).select("sig", F.col("word").alias("a"))
    right = vectors.select("word", F.explode(F.array(*same, *longer)).alias("sig")).select("sig", F.col("word").alias("b"))
    shorter = (F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    return (left.join(right, "sig").filter(shorter).filter(F.levenshtein("a", "b", 1) == 1)
            .select("a", "b").distinct())


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the last word reached; every round doubles the steps."""
    roots = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = roots.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = materialize(roots.join(after, "root", "left").select("word", F.coalesce("far", "root").alias("root"),
                                                                  F.col("far").isNotNull().alias("moved")), "roots")
        roots = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return roots


def variant_groups(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n), whose words are distinct.

    Two words are near if one code point is inserted, deleted or replaced
    between them.  ``form`` is the near word of the largest n, of equal ones the
    smallest in code-point order, where its n is at least ``ratio`` (above 1) times the word's;
    else NULL.  ``root`` is the end of the forms from the word on, the word
    itself where it has none.  An empty table gives none.
    """
    words = materialize(words.select("word", "n"), "words")
    pairs = materialize(near_pairs(words), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).union(pairs.select("b", "a"))
    other = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (both.join(other, "near").groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")))
    chosen = (words.join(best, "word", "left")
              .withColumn("form_n", F.when(-F.col("best.minus") >= ratio * F.col("n"), -F.col("best.minus")))
              .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                      F.when(F.col("form_n").isNotNull(), F.col("best.near")).alias("form"), "form_n"))
    chosen = materialize(chosen, "forms")
    roots = follow(chosen.filter("form IS NOT NULL"))
    return (chosen.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
