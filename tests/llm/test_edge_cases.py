"""Large ids beside NULL, regular words, mixed dimensions, repeated queries, clashing names, long windows, few labels."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkiln.llm import bpe, chunks, exact_topk, minhash, mixing, permutation_index, queries, rlz_dedup, suffix_dedup, toxicity
from tabkiln.llm.common import fresh_names, word_hashes

BIG = 2**53


def morse(n, flip=0):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


@pytest.mark.parametrize("run", [
    suffix_dedup.repeat_digests, rlz_dedup.passage_digests, minhash.near_duplicates,
    lambda df: bpe.encode(df, queries.vocabulary()), lambda df: bpe.encode_digests(df, queries.vocabulary())])
def test_large_ids_beside_null_stay_exact(spark, run):
    rows = [(None, "one two"), (BIG, "three four five"), (BIG + 1, "six seven"), (2**62 + 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = run(df).collect()
    assert {r["doc_id"] for r in got} == {i for i, _ in rows}
    if "component_id" in got[0].asDict():
        assert all(r["component_id"] == r["doc_id"] for r in got)


def test_regular_words_have_hashes_of_their_own():
    words = [morse(1024).encode(), morse(1024, 1).encode(), morse(4096).encode(), morse(4096, 1).encode(), b"ab", b"ba", b"a", b"aa"]
    hashes, offsets = word_hashes([b" ".join(words), b"", b"  ab ", None, words[0]])
    assert len(set(hashes[: len(words)].tolist())) == len(words) and offsets.tolist() == [0, 8, 8, 9, 9, 10]
    assert hashes[8] == hashes[4] and hashes[9] == hashes[0]


def test_texts_of_regular_words_are_not_taken_for_copies(spark):
    a, b = morse(1024), morse(1024, 1)
    head = " ".join(f"w{i}" for i in range(34))
    df = spark.createDataFrame([(1, a), (2, b), (3, f"{head} {a}"), (4, f"{head} {b}")], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(df.filter("doc_id < 3")).collect()} == {(1, 1), (2, 2)}
    assert {r["n_removed"] for r in rlz_dedup.passage_digests(df).collect()} == {0}


def test_repeats_longer_than_ten_thousand_bytes(spark):
    rng = random.Random(3)
    same = "".join(rng.choice("abcdefgh ") for _ in range(13_000))
    texts = [same, "x" + same + "y", same[:11_990] + "!" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.repeat_digests(df, window=12_000).collect()}
    assert got == {0: 13_000, 1: 13_000, 2: 0}


def test_windows_too_long_for_a_chunk_raise():
    with pytest.raises(ValueError, match="longer than the gram"):
        chunks.Plan(words=True, window=70_000, gram=8)


@pytest.mark.parametrize("search", [permutation_index.search, exact_topk.top_k])
def test_searches_take_any_mix_of_rows(spark, search):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(120)] + [(121, [0.5, 0.5]), (None, [1.0] * 4)]
    schema = "vec_id long, embedding array<double>"
    once = sorted(tuple(r) for r in search(spark.createDataFrame(rows, schema)).collect())
    assert once and sorted(tuple(r) for r in search(spark.createDataFrame(rows + [(200, [0.0] * 4), (100, [1.0, 2.0])], schema)).collect())
    twice = sorted(tuple(r) for r in search(spark.createDataFrame(rows + [rows[0]], schema)).collect())
    assert [r for r in twice if r[0] == 0] == [r for r in once if r[0] == 0]
    assert search(spark.createDataFrame(rows[1:19], schema)).count() == 0
    assert search(spark.createDataFrame([(0, [0.0] * 4), (1, [1.0] * 4)], schema)).filter("rank > 1").count() == 0


def test_rows_without_id_meet_their_target(spark):
    rng = random.Random(6)
    rows = [(None if s else 7, " ".join(str(rng.random()) for _ in range(rng.randint(1, 40))), f"s{s}") for s in range(3) for _ in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(df).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"))
    assert all(abs(r["taken"] - r["target"]) <= 0.02 * r["target"] + 40 for r in mixed.collect())


def test_clashing_names_are_carried(spark):
    text = " ".join(f"w{i}" for i in range(50))
    names = "doc_id long, text string, source string, __plan string, __copy int, __r1 int, __ranges string, __cut string, __score int"
    df = spark.createDataFrame([(1, text, "a", "p", 1, 2, "r", "c", 9), (2, text, "a", "p", 1, 2, "r", "c", 9)], names)
    assert fresh_names(df, "__PLAN", "new") == ["__PLAN_", "new"]
    assert mixing.mix_rows(df).columns == rlz_dedup.cut_texts(df).columns == df.columns
    model = toxicity.fit(df, df.selectExpr("doc_id", "cast(0 as int) as toxic"))
    assert [r["__score"] for r in toxicity.keep_clean(df, model).collect()] == [9, 9]


def brute_kernel(a, b):
    def features(word):
        out = collections.Counter()
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + toxicity.SPAN)):
                    out[word[i] + word[j] + word[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    x, y = features(a), features(b)
    dot = sum(v * y[k] for k, v in x.items())
    return dot / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values())) if dot else 0.0


def test_kernel_matches_an_enumeration_of_gapped_subsequences():
    rng = random.Random(8)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 300)]
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(3, 12))) for _ in range(40)]
    marks = words[:15] + ["".join(rng.choices(letters, k=8)) for _ in range(60)]
    kernel = toxicity.Kernel(marks)
    assert kernel.place.nbytes < 10_000_000
    for word, (at, sim) in zip(words, kernel.similarities(words, 0.2)):
        want = np.array([brute_kernel(word, m) for m in marks])
        got = np.zeros(len(marks))
        got[at] = sim
        np.testing.assert_allclose(got, np.where(want >= 0.2, want, 0), atol=1e-9)


def test_one_text_of_either_class_is_told_apart(spark):
    docs = spark.createDataFrame([(i, ["plain text", "horrible word"][i % 2]) for i in range(6)], "doc_id long, text string")
    model = toxicity.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))
    assert {(r["doc_id"] % 2, r["predicted"]) for r in toxicity.score(docs, model).collect()} == {(0, 0), (1, 1)}
