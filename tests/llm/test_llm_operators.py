"""Training-data operators against brute force, with NULLs, empty and long texts, ties, repeated rows and clashing columns."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkiln.llm import bpe, chunks, exact_topk, minhash, mixing, permutation_index, queries, rlz_dedup, suffix_dedup, toxicity, url_cascade, warc
from tabkiln.llm.common import table

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, r1 string, kept string, rank int"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    passage, base = sentence(rng, 130), sentence(rng, 90)
    texts = [None, "", " \t\n", "word", "a b c", "x" * 2000, "ab" * 900, sentence(rng, 6000), passage,
             sentence(rng, 40) + " " + passage + " " + sentence(rng, 30), sentence(rng, 7) + "\n" + passage, base, base]
    for i in range(12):
        words = base.split()
        words[7 * i % 90] = f"edit{i}"
        texts.append(" ".join(words))
    texts += [sentence(rng, rng.randint(1, 200)) for _ in range(60)]
    out = [(i, t, "en", [None, "s1", "s2", "S3"][i % 4], len(t or ""), "clash", "clash", 1) for i, t in enumerate(texts)]
    return out + [out[9], (None, "no id " + base, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def repeated(sequences, n):
    count = collections.Counter(tuple(s[i : i + n]) for s in sequences for i in range(len(s) - n + 1))
    return [[i for i in range(len(s) - n + 1) if count[tuple(s[i : i + n])] > 1] for s in sequences]


def cut(symbols, starts, n):
    gone = sorted({i for s in starts for i in range(s, s + n)})
    runs = sum(1 for i, x in enumerate(gone) if not i or gone[i - 1] != x - 1)
    left = set(gone)
    return [x for i, x in enumerate(symbols) if i not in left], len(gone), runs


@pytest.mark.parametrize("limit", [300_000, 1])
def test_repeated_bytes_match_brute_force(docs, rows, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup, "Plan", lambda **k: chunks.Plan(**k, group_limit=limit, task_bytes=limit))
    bodies = [(r[1] or "").encode() for r in rows]
    want = collections.Counter()
    for r, b, s in zip(rows, bodies, repeated(bodies, 400)):
        kept, n, runs = cut(b, s, 400)
        want[r[0], len(b), n, runs, hashlib.sha256(bytes(kept)).hexdigest()] += 1
    assert collections.Counter(map(tuple, suffix_dedup.repeat_digests(docs).collect())) == want


@pytest.mark.parametrize("limit", [300_000, 1])
def test_repeated_passages_match_brute_force(docs, rows, monkeypatch, limit):
    monkeypatch.setattr(rlz_dedup, "Plan", lambda **k: chunks.Plan(**k, group_limit=limit, task_bytes=limit))
    texts = [WORD.findall(r[1] or "") for r in rows]
    want, whole = collections.Counter(), collections.Counter()
    for r, w, s in zip(rows, texts, repeated(texts, 35)):
        kept, n, _ = cut(w, s, 35)
        want[r[0], len(w), n, hashlib.sha256(" ".join(kept).encode()).hexdigest()] += 1
        whole[r[0], " ".join(kept) if n else r[1], r[2]] += 1
    assert collections.Counter(map(tuple, rlz_dedup.passage_digests(docs).collect())) == want
    out = rlz_dedup.cut_texts(docs, n_chars_col="n_chars")
    assert out.columns == docs.columns
    assert collections.Counter((r["doc_id"], r["text"], r["lang"]) for r in out.collect()) == whole


def test_crowded_anchors_match_brute_force_where_copies_start_anywhere(spark, monkeypatch):
    rng = random.Random(31)
    passages = [sentence(rng, 150).split() for _ in range(30)]
    texts = []
    for i in range(90):
        a, passage = rng.randint(0, 30), passages[i % 30]
        texts.append(" ".join([*sentence(rng, rng.randint(0, 9)).split(), *passage[a : a + rng.randint(50, 90)], *sentence(rng, rng.randint(0, 9)).split()]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for module, window, run, cut_up in ((rlz_dedup, 35, rlz_dedup.passage_digests, str.split), (suffix_dedup, 120, suffix_dedup.repeat_digests, str.encode)):
        monkeypatch.setattr(module, "Plan", lambda **k: chunks.Plan(**k, group_limit=2, task_bytes=1))
        options = {"window": window, "gram": 8 if window == 35 else 40}
        got = {r["doc_id"]: r["n_removed"] for r in run(docs, **options).collect()}
        bodies = [cut_up(t) for t in texts]
        assert got == {i: cut(b, s, window)[1] for i, (b, s) in enumerate(zip(bodies, repeated(bodies, window)))}


def test_collection_bwt_sorts_suffixes():
    rng = random.Random(2)
    for _ in range(60):
        parts = [[rng.randint(1, 3) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 5))]
        text = np.array([x for p in parts for x in [*p, 0]])
        ends = np.flatnonzero(text == 0)
        source, bwt, lcp = suffix_dedup.collection_bwt(text, ends)

        def suffix(i):
            e = int(ends[np.searchsorted(ends, i)])
            return [(x, 0) for x in text[i:e]] + [(0, int(np.searchsorted(ends, i)))]

        order = sorted(range(len(text)), key=suffix)
        assert order == source.tolist()
        assert [0 if i == 0 or text[i - 1] == 0 else text[i - 1] for i in order] == bwt.tolist()
        for k in range(1, len(order)):
            a, b = suffix(order[k - 1]), suffix(order[k])
            assert lcp[k] == next(n for n, (x, y) in enumerate(zip(a, b)) if x != y)


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_match_brute_force(docs, rows, k):
    named = [(r[0], WORD.findall((r[1] or "").translate(LOWER))) for r in rows]
    sets = [(i, {tuple(w[j : j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()) for i, w in named]
    group = {i: i for i, _ in sets if i is not None}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and a and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    want = collections.Counter((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets)
    assert collections.Counter(map(tuple, minhash.near_duplicates(docs, shingle=k).collect())) == want


def test_repeated_rows_and_ids_keep_their_links(spark):
    rng = random.Random(12)
    base, other = (sentence(rng, 60).split() for _ in range(2))
    near = [" ".join([*base[:-1], f"end{i}"]) for i in range(3)]
    sids = spark.createDataFrame([(i, i) for i in range(3)], "sid long, comp long")
    texts = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(near) for _ in range(3 if i == 1 else 1)], "sid long, body binary")
    assert sorted(map(tuple, minhash._prefix_pairs(sids, texts, 5, 80).collect())) == [(0, 1), (0, 2), (1, 2)]
    rows = [(2, near[0]), (3, near[1]), (3, " ".join(other)), (3, ""), (4, " ".join([*other[:-1], "end"])), (9, near[2]), (9, near[2]), (9, near[2]), (11, "alone"), (11, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.Counter((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert got == {(2, 2, True): 1, (3, 2, False): 3, (4, 2, False): 1, (9, 2, False): 3, (11, 11, True): 2}


def test_bpe_matches_the_tokenizers_library(docs, rows):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(queries.vocabulary())
    extra = ["<|endoftext|>x<|startoftext|> 'LL it's", "ΑΣ É ß\x1c\x85 ...!!22", "a" * 3000]
    spark = docs.sparkSession
    some = docs.select("doc_id", "text").union(spark.createDataFrame([(1000 + i, x) for i, x in enumerate(extra)], "doc_id long, text string"))
    want = collections.Counter()
    for i, x in [(r[0], r[1]) for r in rows] + [(1000 + i, x) for i, x in enumerate(extra)]:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want[i, tuple(ids), t.decode(ids, skip_special_tokens=False)] += 1
    got = bpe.encode(some, queries.vocabulary()).collect()
    assert collections.Counter((r[0], tuple(r[1]), r[2]) for r in got) == want


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(400, 16)).round(3)
    v[100:160] = v[100]
    out = [(i, [float(x) for x in r], 1, 2) for i, r in enumerate(v)]
    out += [(1000, None, 1, 2), (1001, [], 1, 2), (1002, [float("nan")] * 16, 1, 2), (1020, [0.0] * 16, 1, 2), (1040, [None] * 16, 1, 2),
            (None, [1.0] * 16, 1, 2), (40, out[40][1], 1, 2)]
    return spark.createDataFrame(out, "vec_id long, embedding array<float>, rank int, score int")


def plain_vectors(vectors, zero):
    out = []
    for r in vectors.collect():
        v = r["embedding"]
        if r["vec_id"] is not None and v and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v)):
            out.append((r["vec_id"], np.array(v, float)))
    return out


def test_exact_top_k_matches_brute_force(vectors):
    plain = [(i, np.floor(256 * v).astype(int)) for i, v in plain_vectors(vectors, True)]
    want = collections.Counter()
    for q, x in {i: v for i, v in plain if i % 50 == 0}.items():
        best = sorted((-int(x @ v), i) for i, v in plain if i != q)[:5]
        want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(best))
    assert collections.Counter(map(tuple, exact_topk.top_k(vectors).collect())) == want


def test_huge_components_are_scored_exactly(spark):
    df = spark.createDataFrame([(0, [2.0**20, 1.0]), (1, [2.0**24, 3.0]), (2, [2.0**24, 2.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in exact_topk.top_k(df).collect()]
    assert got == [(0, 1, 1, 2**60 + 3 * 2**16), (0, 2, 2, 2**60 + 2 * 2**16)]


def test_permutation_index_recall_and_exact_scores(vectors):
    plain = plain_vectors(vectors, False)
    got = collections.defaultdict(dict)
    for r in permutation_index.search(vectors).collect():
        got[r["query_id"]][r["vec_id"]] = r["score"]
    hit = total = 0
    for q, x in {i: v for i, v in plain if i % 20 == 0}.items():
        best = sorted((-float(np.cumsum(x * v)[-1]), i) for i, v in plain if i != q)[:20]
        hit += len({i for _, i in best} & set(got[q]))
        total += len(best)
        for i, s in got[q].items():
            assert s == pytest.approx(float(x @ dict(plain)[i]), abs=1e-12)
    assert hit / total >= 0.9


def test_url_rules_follow_the_longest_fit(spark):
    rules = queries.URL_RULES
    urls = [None, "", "no scheme", "http://Example.COM/en/x", "https://www.example.com/en/", "http://a.www.example.com/en/y?q#f", "http://example.com",
            "http://x.net/es/1", "http://net/fr/", "http://badexample.com/en/", "http://x.net/fr", "ftp://h.org/en/#?/", "http://x.net/es/1"] + [f"http://h{i}.net/{i}/p" for i in range(300)]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    for r in url_cascade.judge(df, rules).collect():
        u = r["url"] or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0].translate(LOWER)
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        fit = max(((len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, fit and fit[2], fit[3] if fit else "allow")


def test_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    listed = universe.filter("cast(substring(key, 2) as int) % 7 = 0")
    levels = url_cascade.build_cascade(listed, universe)
    got = universe.filter(url_cascade.member(levels, F.col("key"))).exceptAll(listed).count()
    assert got == 0 and universe.filter(url_cascade.member(levels, F.col("key"))).count() == listed.count()


def test_archives_round_trip(spark):
    page = "<p>é</p>" * 300
    data = [(1, "u", page), (2, "u\r\nX: y", page), (3, None, page), (3, None, page), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (None, "u", page), (9, "u", "z" * 900_000)]
    df = spark.createDataFrame([(*r, "clash") for r in data], "page_id long, url string, html string, digest string").repartition(3)
    want = collections.Counter()
    for i, _, h in data:
        b = (h or "").encode()
        back = i in (1, 2)
        want[i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if back else "response", 3 if back else None] += 1
    assert collections.Counter(map(tuple, warc.archive_round_trip(df).collect())) == want


def test_archives_keep_large_ids(spark):
    page, first = "<p>é</p>" * 300, 2**53 + 1
    df = spark.createDataFrame([(first, "u", page), (first + 2, "u", page), (first + 4, "u", "short"), (None, "u", "none")], "page_id long, url string, html string").coalesce(1)
    got = {(r["page_id"], r["refers_to"]) for r in warc.archive_round_trip(df).select("page_id", "refers_to").collect()}
    assert got == {(first, first + 2), (first + 2, None), (first + 4, None), (None, None)}


def test_mix_never_takes_a_row_more_often_than_the_cap(spark):
    rows = [(i, "w" if i == 0 else "", "a") for i in range(50)] + [(100 + i, "w " * 50, "b") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for weights in ((5.0, 1.0), (1.0, 5.0)):
        most = mixing.mix_rows(docs, weights=weights).groupBy("doc_id").count().agg(F.max("count")).first()[0]
        assert most <= 3 and mixing.mix(docs, weights=weights).agg(F.max("copies")).first()[0] <= 3


def test_mix_hits_targets_and_caps(docs, spark):
    big = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 17 + 1).cast("int")).alias("text"),
                                   F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 50 == 1, "b").when(F.col("id") % 5 > 0, "c").alias("source"))
    for df, near in ((docs, 0.6), (big, 0.01)):
        out = mixing.mix(df).collect()
        by = collections.defaultdict(lambda: [0, 0, 0.0])
        for r in out:
            assert 0 <= r["copies"] <= 3
            b = by[r["source"]]
            b[0] += r["size"]
            b[1] += r["size"] * r["copies"]
            b[2] = r["target"]
        assert sum(b[2] for b in by.values()) == pytest.approx(sum(b[0] for b in by.values()))
        for size, taken, target in by.values():
            assert target <= 3 * size + 1e-6 and abs(taken - target) <= near * size
        assert sorted(map(repr, mixing.mix(df).collect())) == sorted(map(repr, out))
    taken = mixing.mix_rows(docs)
    assert taken.columns == docs.columns
    assert taken.count() == sum(r["copies"] for r in mixing.mix(docs).collect())


def test_string_kernel_tolerates_inserted_characters():
    kernel = toxicity.Kernel([toxicity.START + "stupid", toxicity.START + "worthless"])
    same, slipped, other = (dict(zip(*map(list, s))) for s in kernel.similarities([toxicity.START + w for w in ("stupid", "stuxpid", "thereof")], 0.0))
    assert same[0] == pytest.approx(1.0) and 0.55 < slipped[0] < 1 and other.get(0, 0) < 0.3
    assert "stupid" in toxicity.tokens("you S.t-u_p*i/d one") and "idiot" in toxicity.tokens("an i d i o t")


def test_toxicity_holds_out_and_scores_every_text(docs, spark):
    sf = "/root/testdata/sf0.1"
    texts, labels = table(spark, sf, "documents").filter("lang = 'en'"), table(spark, sf, "labels")
    model = toxicity.fit(texts, labels)
    got = toxicity.score(texts, model).join(labels, "doc_id").filter("held_out")
    right, n = got.agg(F.sum((F.col("predicted") == F.col("toxic")).cast("int")), F.count("*")).first()
    assert right / n > 0.95
    out = toxicity.score(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    none = toxicity.fit(docs, labels.limit(0))
    assert all(r["score"] == pytest.approx(0.0, abs=1e-6) for r in toxicity.score(docs, none).collect())
    assert toxicity.keep_clean(docs, model).columns == docs.columns


def test_toxicity_learns_from_few_labels(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abdefgiklmnoprstuvz") for _ in range(rng.randint(4, 9))) for _ in range(2000)]
    texts = [(i, " ".join(rng.choices(words, k=25) + [["qwxhyj", "jyqqwc", "cwhjxq"][i // 2 % 3]] * (i % 2))) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).filter("doc_id >= 80")
    caught, kept = got.agg(F.avg(F.expr("if(doc_id % 2 = 1, predicted, null)")), F.avg(F.expr("if(doc_id % 2 = 0, 1 - predicted, null)"))).first()
    assert caught > 0.9 and kept > 0.7
    for sf, least, most in (("sf0.001", 1, 0.1), ("sf0.01", 9, 0.05)):
        docs, labels = (table(spark, f"/root/testdata/{sf}", t) for t in ("documents", "labels"))
        got = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").filter("held_out")
        assert got.filter("toxic = 1 AND predicted = 1").count() >= least
        assert got.filter("toxic = 0").agg(F.avg("predicted")).first()[0] < most


def test_toxicity_takes_long_words_as_landmarks(spark):
    docs = spark.createDataFrame([(i, "ab" * 40 if i % 2 else "plain text") for i in range(20)], "doc_id long, text string")
    model = toxicity.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))
    assert {(r["doc_id"] % 2, r["predicted"]) for r in toxicity.score(docs, model).collect()} == {(0, 0), (1, 1)}


def test_operators_take_empty_tables(docs, vectors, spark):
    none, no_vectors = docs.limit(0), vectors.limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for df in (suffix_dedup.repeat_digests(none), rlz_dedup.passage_digests(none), rlz_dedup.cut_texts(none), minhash.near_duplicates(none),
               bpe.encode_digests(none, queries.vocabulary()), exact_topk.top_k(no_vectors), permutation_index.search(no_vectors),
               warc.archive_round_trip(pages), url_cascade.judge(pages, queries.URL_RULES), mixing.mix(none), mixing.mix_rows(none)):
        assert df.count() == 0


def test_pipeline_stages_follow_their_operators(spark):
    import corpus_pipeline

    docs = table(spark, SMALL, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "passages", "mixing", "bpe"]
    clean = corpus_pipeline.drop_toxic(spark, docs, SMALL)
    single = corpus_pipeline.drop_near_duplicates(spark, clean, SMALL)
    groups = minhash.near_duplicates(clean, shingle=5)
    assert {r["doc_id"] for r in single.collect()} == {r["doc_id"] for r in groups.collect() if r["kept"]}
    assert clean.columns == single.columns == corpus_pipeline.COLUMNS
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "ids", "decoded"]
    assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in single.collect()}


def test_pipeline_keeps_one_copy_of_repeated_rows(spark):
    import corpus_pipeline

    rng = random.Random(21)
    texts = [sentence(rng, 60) for _ in range(4)]
    rows = [(1, texts[0])] * 3 + [(None, texts[1])] * 2 + [(None, texts[0]), (5, texts[2]), (None, texts[3]), (6, None), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int").repartition(3)
    single = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    assert single.columns == corpus_pipeline.COLUMNS
    want = collections.Counter([(1, texts[0]), (None, texts[1]), (5, texts[2]), (None, texts[3]), (6, None), (None, None), (None, "")])
    assert collections.Counter((r["doc_id"], r["text"]) for r in single.collect()) == want
    passages = corpus_pipeline.drop_passages(spark, single, SMALL)
    assert collections.Counter((r["doc_id"], r["text"]) for r in passages.collect()) == want


def test_bpe_keeps_words_when_the_pieces_start_anew(monkeypatch):
    w = bpe.WordBpe(queries.vocabulary())
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    asked, rounds = [], w.merge_rounds
    monkeypatch.setattr(w, "merge_rounds", lambda words: asked.append(words) or rounds(words))
    first = list(w.encode([b"ab Ab aB AB"]))
    again = list(w.encode([b"AB aB Ab ab"]))
    assert asked == [["ab"]] and first == again


def test_near_pairs_are_written_before_their_texts_are_joined(docs, monkeypatch):
    plans, write = [], minhash.materialize

    def spy(df, name):
        if name == "links":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(minhash, "materialize", spy)
    minhash.near_duplicates(docs, shingle=4, percent=80).collect()
    assert plans and not any("bit_count" in p or "bitcount" in p for p in plans)


def test_texts_out_of_play_are_left_out_before_a_shuffle(spark, docs, monkeypatch):
    hashed = spark.range(5000).select("id", F.xxhash64("id").alias("t")).union(spark.sql("SELECT 7000L, -1L"))
    wanted = {r["id"]: r["t"] for r in hashed.filter("id % 500 = 0").collect()}
    left = {r["id"]: r["t"] for r in minhash._possible(hashed, hashed.filter("id % 500 = 0").select("t")).collect()}
    assert wanted.items() <= left.items() and len(left) < len(wanted) + 20
    assert 7000 in {r["id"] for r in minhash._possible(hashed, hashed.filter("t = -1").select("t")).collect()}

    plans, write = [], minhash.materialize

    def spy(df, name):
        if name == "texts":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(minhash, "materialize", spy)
    minhash.near_duplicates(docs, shingle=4, percent=80).collect()
    assert len(plans) == 1 and "getbit" in plans[0]
