"""Periodic runs, spelling variants and SentencePiece against brute force and the library."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tabkiln.llm import periodic_runs, queries, sentence_pieces, spelling

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BIG = 2**53 + 1
SCHEMA = "doc_id long, text string, lang string, runs string, ids string, word int, g int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    names = ["edification", "edificatión", "Ünterlagen", "beauteous", "abcdefgh", "aaaaaaaa", "straße", "naïvement"]
    texts = [None, "", " \t\n ", "word", "a a a a a", "a a a a a a", "x y " * 9, "ab ab ab cd " * 40, "z " * 9000,
             "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(3000)), "q" * 5000, "▁▁ ▁a <s></s><0x41> \U0001F9FF\x00  end  "]
    for _ in range(160):
        w = [rng.choice(names + ["ein", "of", "the", "4711", "e-mail"]) for _ in range(rng.randint(1, 60))]
        for _ in range(2):
            at, p = rng.randrange(len(w)), rng.randint(1, 6)
            for i in range(at, rng.randint(at, len(w))):
                w[i] = w[at + (i - at) % p]
        i = rng.randrange(len(w))
        w[i] = w[i][:3] + rng.choice("aeé") + w[i][rng.choice([3, 4]):]
        texts.append(rng.choice([" ", "  ", "\n"]).join(w))
    out = [(i, t, "en", "clash", "clash", 1, 2) for i, t in enumerate(texts)]
    return out + [out[20], (BIG, texts[30], None, None, None, None, None), (None, texts[7], None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - s
            part = w[s : s + n]
            if n >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((s, n, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    s, n, q = best or (None, None, None)
    return (doc_id, len(runs), s, n, q, best and 1000 * n // q, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_periodic_runs_match_brute_force(docs, rows):
    got = [tuple(r) for r in periodic_runs.run_digests(queries.with_periods(docs)).collect()]
    assert collections.Counter(got) == collections.Counter(brute_row(r[0], r[1]) for r in rows)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in rows)


def test_periodic_runs_of_random_words_match_brute_force(monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLAB", 8)
    rng = random.Random(2)
    for _ in range(60):
        texts = [[b"%d" % rng.randint(1, rng.choice([1, 2, 3, 40])) for _ in range(rng.choice([0, 1, 6, 9, 40, 120]))] for _ in range(5)]
        assert periodic_runs.runs_of(texts) == [brute_runs(t) for t in texts]


def test_transform_gives_the_exact_correlation():
    rng = np.random.default_rng(3)
    for size in (1, 2, 8, 64):
        flat = np.concatenate([rng.integers(0, 3, 6 * size), 1000 + np.arange(3 * size)]).astype(np.uint64)
        place, distance = periodic_runs.block_copies(flat, size, 6)
        want = [(j * size, d) for j in range(6) for d in range(size, 2 * size)
                if (flat[j * size : (j + 1) * size] == flat[j * size + d : (j + 1) * size + d]).all()]
        assert list(zip(place.tolist(), distance.tolist())) == want


def test_collapsed_text_keeps_the_first_period(spark):
    df = spark.createDataFrame([("k", "x a b a b a b a b y"), (None, None)], "doc_id string, text string")
    got = {r["doc_id"]: r for r in periodic_runs.periodic_runs(df).collect()}
    assert [tuple(r) for r in got["k"]["runs"]] == [(1, 8, 2)] and got["k"]["collapsed"] == "x a b y" and got["k"]["n_words"] == 10
    assert got[None]["runs"] == [] and got[None]["collapsed"] == ""


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(n, ratio):
    out = {}
    for w in n:
        close = [v for v in n if near(w, v)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = [form, w, n[w], len(close), n[form] if form else None]
    for w in out:
        while out[out[w][1]][0]:
            out[w][1] = out[out[w][1]][0]
    return {(w, *r) for w, r in out.items()}


def test_spelling_variants_of_texts_match_brute_force(docs, rows):
    n = collections.Counter()
    for r in rows:
        for run in LETTERS.findall(r[1] or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    runs = spelling.letter_runs(docs, least=7)
    got = spelling.variant_groups(spelling.count_words(queries.with_slips(runs)))
    assert {tuple(r) for r in got.collect()} == brute_groups(n, 10) and any(form for _, form, *_ in brute_groups(n, 10))


def test_no_near_pair_is_lost(spark):
    rng = random.Random(9)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(500)} | {"é" * i for i in range(1, 9)} | {"a", "b"}
    got = {tuple(r) for r in spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert {frozenset(p) for p in got} == {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}
    assert len(got) == len({frozenset(p) for p in got})


def test_forms_are_followed_to_the_last(spark):
    n = {"abcdefg": 10**6, "abcdefgh": 10**5, "abcdefghi": 10**4, "abcdefghij": 1000, "abcdefghijk": 100, "abcdefghijkl": 10, "zzzzzzz": 3,
         "yyyyyyy": 5, "yyyyyyyx": 50, "yyyyyyyw": 50}
    got = {tuple(r) for r in spelling.variant_groups(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert got == brute_groups(n, 10) and ("abcdefghijkl", "abcdefghijk", "abcdefg", 10, 1, 100) in got
    assert ("yyyyyyy", "yyyyyyyw", "yyyyyyyw", 5, 2, 50) in got


def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))


def test_pieces_equal_the_library(docs, rows):
    lib = library()
    got = [tuple(r) for r in sentence_pieces.encode(docs, queries.vocabulary("piece_bpe_32k.model")).select("doc_id", "ids", "decoded").collect()]
    want = [(r[0], tuple(lib.encode(r[1] or "")), lib.decode(lib.encode(r[1] or ""))) for r in rows]
    assert collections.Counter((i, tuple(x), d) for i, x, d in got) == collections.Counter(want)


def test_both_segmentations_and_decoding_equal_the_library():
    lib, own = library(), sentence_pieces.PieceBpe(queries.vocabulary("piece_bpe_32k.model"))
    rng = random.Random(4)
    common = "the  ing▁ation 12'\n\té日🙂́"
    texts = ["".join(rng.choice(common) if rng.random() < 0.8 else chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x1FFFF)]))
                     for _ in range(rng.randint(0, 90))) for _ in range(1500)]
    for t, (ids, decoded) in zip(texts, own.encode(texts)):
        want = lib.encode(t)
        assert np.frombuffer(ids, "<i4").tolist() == want and decoded == lib.decode(want)
    chunks = sorted({c for t in texts for c in own.chunks.findall("▁" + t.replace(" ", "▁"))})
    flat, ends = own.segment_all(chunks)
    assert [x.tolist() for x in np.split(flat, ends[:-1])] == [own.segment(c) for c in chunks]
    for _ in range(800):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(3, 31999)]) for _ in range(rng.randint(0, 10))]
        assert own.decode(ids) == lib.decode(ids)


def test_table_of_chunks_does_not_change_results(monkeypatch):
    path = queries.vocabulary("piece_bpe_32k.model")
    texts = ["one two three " * 5, "four five " + "x" * 300, "one four"]
    want = list(sentence_pieces.PieceBpe(path).encode(texts))
    monkeypatch.setattr(sentence_pieces, "TABLE_CHUNKS", 1)
    own = sentence_pieces.PieceBpe(path)
    assert [x for t in texts for x in own.encode([t])] == want and not any(len(c) > sentence_pieces.KEPT_CHARS for c in own.table)


def test_a_model_of_another_kind_raises(tmp_path):
    path = tmp_path / "other.model"
    path.write_bytes(b"\x12\x02\x18\x01")
    with pytest.raises(ValueError, match="BPE"):
        sentence_pieces.PieceBpe(str(path))


def test_empty_tables_give_none(empty):
    assert periodic_runs.run_digests(queries.with_periods(empty)).count() == 0
    assert spelling.variant_groups(spelling.count_words(queries.with_slips(spelling.letter_runs(empty)))).count() == 0
    assert sentence_pieces.encode(empty, queries.vocabulary("piece_bpe_32k.model")).count() == 0


def test_large_ids_beside_null_stay_exact(spark):
    df = spark.createDataFrame([(None, "a b"), (BIG, "a b"), (2**62 + 1, None)], "doc_id long, text string").coalesce(1)
    ids = {None, BIG, 2**62 + 1}
    assert {r[0] for r in periodic_runs.periodic_runs(df).collect()} == ids
    assert {r[0] for r in sentence_pieces.encode(df, queries.vocabulary("piece_bpe_32k.model")).collect()} == ids
    assert {r[0] for r in periodic_runs.run_digests(queries.with_periods(df)).select(F.col("doc_id")).collect()} == ids
