from pyspark.sql import functions as F

from tabkiln.operators import segments, triples


def test_window_counts(spark):
    rows = [(n, " ".join(f"w{i}" for i in range(n))) for n in (0, 1, 256, 257, 448, 449, 1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    w = segments.text_windows(df, "doc_id", "text", 256, 64)
    counts = {r["doc_id"]: r["count"] for r in w.groupBy("doc_id").count().collect()}
    assert counts == {0: 1, 1: 1, 256: 1, 257: 2, 448: 2, 449: 3, 1000: 5}
    last = w.filter("doc_id = 1000").orderBy(F.col("seg_no").desc()).first()
    assert last["tokens"][-1] == "w999"


def test_max_strategy_ties_first_segment(spark):
    df = spark.createDataFrame(
        [(1, 0, [0.0, 2.0]), (1, 1, [5.0, 2.0]), (1, 2, [1.0, 1.0])], "id long, seg_no int, logits array<double>"
    )
    got = segments.aggregate_segments(df, "id", "logits", "max").first()
    assert got["logits"] == [0.0, 2.0]
    mean = segments.aggregate_segments(df, "id", "logits", "mean").first()
    assert mean["logits"] == [2.0, 5.0 / 3.0]


def test_triples_parse_multiple_pairs_and_specials(spark):
    text = "<s><triplet> Punta Cana <subj> Dominican Republic <obj> country <subj> La Altagracia <obj> located in</s>"
    df = spark.createDataFrame([(1, text), (2, "no markers here"), (3, "<triplet> A <subj> B <obj> r1 <triplet> C <subj> D <obj> r2")], "id long, t string")
    got = sorted(tuple(r) for r in triples.triples_from_tags(df, "id", "t").collect())
    assert got == [
        (1, "Punta Cana", "country", "Dominican Republic"),
        (1, "Punta Cana", "located in", "La Altagracia"),
        (3, "A", "r1", "B"),
        (3, "C", "r2", "D"),
    ]


def test_graph_degrees_parse_each_text_once(spark):
    n = 2000
    text = "<triplet> hub" + "".join(f" <subj> leaf{i} <obj> has" for i in range(n)) + " <triplet> <subj> x <obj> r"
    df = spark.createDataFrame([(1, text), (None, "<triplet> leaf0 <subj> hub <obj> of <subj> <obj> r"), (3, None)], "id long, t string")
    found = triples.triples_from_tags(df, "id", "t")
    degrees = triples.graph_degrees(found)
    assert degrees._jdf.queryExecution().sparkPlan().toString().count("Scan ExistingRDD") == 1
    got = {r["node"]: (r["out_degree"], r["in_degree"]) for r in degrees.collect()}
    # the pair without a head ends its text and is left out, so is the one without a tail
    assert got == {"hub": (n, 1), "leaf0": (1, 1)} | {f"leaf{i}": (0, 1) for i in range(1, n)}
    assert {r["node"] for r in triples.graph_vertices(found).collect()} == set(got)


def test_keyword_lookup_matches_subject_case_insensitive(spark):
    t = spark.createDataFrame([(1, "Paris", "capital of", "France")], triples.TRIPLE_SCHEMA)
    q = spark.createDataFrame([("q1", "What is PARIS?"), ("q2", "Where is Rome?")], "qid string, q string")
    hits = triples.lookup_triples(q, "qid", "q", t).collect()
    assert [(h["qid"], h["tail"]) for h in hits] == [("q1", "France")]


def test_lookup_finds_the_phrases_a_scan_finds(spark):
    import random
    import re

    rng = random.Random(3)
    vocab = ["the", "of", "red", "blue", "stone", "river", "x1", "a_b"]
    heads = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 4))) for _ in range(60)] + ["The", "of the", "", "red " * 40, "unseen red"]
    texts = [" ".join(rng.choice(vocab + ["green"]) for _ in range(rng.randint(0, 12))) for _ in range(40)] + [None, "Red, STONE! river", "red " * 45]
    queries = spark.createDataFrame(list(enumerate(texts)) + [(0, "red stone")], "q long, text string")
    facts = spark.createDataFrame([(i, h, "rel", f"t{i}") for i, h in enumerate(heads)], "chunk_id long, head string, relation string, tail string")
    words = lambda t: re.findall("[a-z0-9_#]+", (t or "").lower())
    stop = set(triples.STOPWORDS)
    want = {(q, i) for q, t in list(enumerate(texts)) + [(0, "red stone")] for i, h in enumerate(heads)
            if set(words(h)) - stop and f" {' '.join(words(h))} " in f" {' '.join(words(t))} "}
    got = [(r["q"], r["chunk_id"]) for r in triples.lookup_triples(queries, "q", "text", facts).collect()]
    assert set(got) == want and len(got) == len(want)
    short = triples.lookup_triples(queries, "q", "text", facts, max_words=2).collect()
    assert {(r["q"], r["chunk_id"]) for r in short} == {(q, i) for q, i in want if len(words(heads[i])) <= 2}
