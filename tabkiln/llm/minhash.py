"""Near-duplicate groups by b-bit MinHash.

Every distinct shingle set gets ``bands * rows`` minima.  Whole minima make the
band keys; the low ``BITS`` bits of each are packed into a signature.  Sets
that share a band key are candidates if their signatures agree often enough:
the share of agreeing lanes, corrected for lanes that agree by chance, must
come within six standard deviations of the threshold.  Candidates are
confirmed on their full sets.

No bucket is expanded into all its pairs.  First every bucket member meets
one representative of its bucket, then another one; members already in one
component are never compared again.  What is left are members of buckets of
three or more that span several components: of these, every pair that a prefix filter over their
full sets lets through is compared too, so no link between them is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.common import byte_batches, gram_hash, materialize, mix, prefix_hash, range_hash, release, word_hashes
from tabkiln.llm.components import merge_components

BANDS, ROWS, BITS = 32, 4, 2
LANES = BANDS * ROWS
WORDS = LANES * BITS // 64
STAR_ROUNDS = 2
#: 64-bit words of the filter that keeps texts out of the shuffle: at most so many short rows are broadcast.
FILTER_WORDS = 2**19

_RNG = np.random.default_rng(7)
_A = _RNG.integers(1, 2**63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(1, 2**63, LANES, dtype=np.uint64)


def shingle_sets(bodies: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``k``-word shingles (ASCII lower case; a shorter text is one shingle)."""
    words, off = word_hashes(bodies, lower=True)
    prefix = prefix_hash(words)
    grams = gram_hash(prefix, k)
    out = []
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        else:
            out.append(range_hash(prefix, np.array([a]), np.array([b])) if b > a else np.zeros(0, np.uint64))
    return out


def minima(values: np.ndarray) -> np.ndarray:
    out = np.full(LANES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(values), 1024):
        block = np.multiply.outer(_A, values[i : i + 1024])
        block += _B[:, None]
        np.minimum(out, block.min(axis=1), out=out)
    return out


def _signatures(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bodies = [b or b"" for b in pdf["body"]]
            for lo, hi in byte_batches(bodies):
                rows = []
                for values in shingle_sets(bodies[lo:hi], k):
                    if not len(values):
                        rows.append((0, 0, 0, [0] * WORDS, []))
                        continue
                    m = minima(values)
                    bands = mix(prefix_reduce(m.reshape(BANDS, ROWS)) + np.arange(BANDS, dtype=np.uint64))
                    lanes = ((m >> np.uint64(40)) & np.uint64((1 << BITS) - 1)).reshape(WORDS, -1)
                    sig = (lanes << (np.arange(lanes.shape[1], dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)
                    s1, s2 = mix(values).sum(dtype=np.uint64), mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
                    rows.append((len(values), int(s1.view(np.int64)), int(s2.view(np.int64)), sig.view(np.int64), bands.view(np.int64)))
                n, s1, s2, sig, bands = zip(*rows)
                yield pd.DataFrame({"id": pdf["id"].iloc[lo:hi].array, "t": pdf["t"].iloc[lo:hi].array, "n": n, "s1": s1, "s2": s2, "sig": sig, "bands": bands})
        release()
    return run


def prefix_reduce(rows: np.ndarray) -> np.ndarray:
    """One hash for each row of minima."""
    out = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out


def least_agreement(threshold: float) -> int:
    """Lanes that must agree: the expected number at the threshold less six standard deviations."""
    chance = 2.0**-BITS
    p = chance + (1 - chance) * threshold
    return math.floor(LANES * p - 6 * math.sqrt(LANES * p * (1 - p)))


def agreeing_lanes(a: str, b: str) -> Column:
    """Lanes in which two packed signatures agree (two-bit lanes)."""
    differ = F.lit(0)
    for i in range(WORDS):
        x = f"({a}[{i}] ^ {b}[{i}])"
        differ = differ + F.expr(f"bit_count(({x} | shiftrightunsigned({x}, 1)) & {0x5555555555555555}L)")
    return F.lit(LANES) - differ


def _confirm(k: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            for a, b in zip(pdf["body_a"], pdf["body_b"]):
                x, y = shingle_sets([a, b], k)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield pdf.loc[keep, ["a", "b"]]
        release()
    return run


def _prefix_pairs(sids: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of ``sids`` (sid, comp) in different components that can be similar enough.

    Two sets that overlap by ``need`` shingles share one among the first ``size - need + 1`` of each, in any order of
    all shingles; with rare shingles first, edited copies of one text seldom do.
    """
    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bodies = list(pdf["body"])
            for lo, hi in byte_batches(bodies):
                found = shingle_sets(bodies[lo:hi], k)
                size = [len(x) for x in found]
                yield pd.DataFrame({"sid": np.repeat(pdf["sid"].to_numpy()[lo:hi], size), "comp": np.repeat(pdf["comp"].to_numpy()[lo:hi], size),
                                    "sh": np.concatenate(found).view(np.int64)})

    shingles = materialize(sids.join(texts, "sid").mapInPandas(explode, "sid long, comp long, sh long"), "shingles")
    counts = shingles.groupBy("sh").agg(F.count("*").alias("c"))
    ranked = (shingles.join(counts, "sh").groupBy("sid", "comp")
              .agg(F.sort_array(F.collect_set(F.struct("c", "sh"))).alias("all"))
              .withColumn("n", F.size("all"))
              .select("sid", "comp", "n", F.posexplode(F.expr(f"slice(all, 1, cast(n - ceil({percent} * n / 100) + 1 as int))")).alias("pos", "x"))
              .filter("x.c > 1").select("sid", "comp", "n", "pos", F.col("x.sh").alias("sh")))
    ranked = materialize(ranked, "prefixes")

    def need(n: str, m: str) -> str:
        return f"ceil({percent} * ({n} + {m}) / {100 + percent})"

    x = ranked.filter(f"pos <= n - {need('n', 'n')}").toDF("a", "ca", "na", "pa", "sh")
    y = ranked.toDF("b", "cb", "nb", "pb", "sh")
    pairs = (x.join(y, "sh").filter("ca <> cb AND (na < nb OR (na = nb AND a < b))").filter(f"na * 100 >= nb * {percent}")
             .filter(f"pa <= na - {need('na', 'nb')} AND pb <= nb - {need('na', 'nb')}"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _possible(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` without those whose hash ``t`` cannot be one of ``wanted``'s.

    A bitmap of bounded size is broadcast, so no row is shuffled; some others pass, and the fuller it is the more.
    """
    word, bit = F.expr(f"shiftrightunsigned(t, 6) & {FILTER_WORDS - 1}L"), "cast(t & 63 as int)"
    bitmap = wanted.groupBy(word.alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("bits"))
    return rows.withColumn("word", word).join(F.broadcast(bitmap), "word").filter(f"getbit(bits, {bit}) = 1").drop("word", "bits")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``df``.

    Texts are linked if their sets of ``shingle``-word shingles have a Jaccard
    similarity of at least ``percent`` / 100.  ``component_id`` is the smallest
    id reachable over links, ``kept`` marks the row that has it.  NULL, empty
    and word-free texts have no shingles and no links.  A row without id takes
    no part: its component is NULL and it is kept.  Rows that repeat an id share
    its component.  Ids are whole numbers; others raise.
    """
    spark_long = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("body")).withColumn("t", F.xxhash64("body"))
    signed = (spark_long.withColumn("id", F.col("id").cast("string"))  # pandas rounds large numbers beside NULL
              .mapInPandas(_signatures(shingle), "id string, t long, n long, s1 long, s2 long, sig array<long>, bands array<long>"))
    sets = materialize(signed.withColumn("id", F.col("id").cast("long")), "minhash")
    linked = sets.filter("n > 0 AND id IS NOT NULL")
    # one class a set, named by a hash (sid), not by its least id (head): an id with two texts can be that of two classes
    classes = materialize(linked.groupBy("s1", "s2").agg(F.min(F.struct("id", "t")).alias("h"))
                          .select("s1", "s2", F.xxhash64("s1", "s2").alias("sid"), F.col("h.id").alias("head"), F.col("h.t").alias("t")), "classes")
    # a class has one row of names, so the join's keys name it too, and its rows lie together as the join leaves them
    keys = ["s1", "s2", "t", "id"]
    reps = (linked.join(classes.withColumnRenamed("head", "id"), keys).dropDuplicates(keys)
            .select("sid", F.col("id").alias("head"), "t", "n", "sig", "bands"))
    bands = reps.select("sid", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    buckets = materialize(bands.join(shared, "key", "left_semi"), "buckets")
    in_play = buckets.select("sid").distinct()
    marks = materialize(reps.select("sid", "head", "t", "n", "sig").join(in_play, "sid"), "marks")
    bodies = spark_long.filter("body IS NOT NULL").withColumnRenamed("id", "head")
    # few texts are in play: the others are left out before any is shuffled
    texts = materialize(marks.select("sid", "head", "t").join(_possible(bodies, marks.select("t")), ["head", "t"])
                        .dropDuplicates(["head", "t", "sid"]).select("sid", "body"), "texts")
    marks = marks.select("sid", "n", "sig")
    named = materialize(linked.select("id", "s1", "s2").distinct().join(classes.drop("t"), ["s1", "s2"]).select("id", "sid", "head"), "named")
    several = named.groupBy("id").agg(F.min("sid").alias("a"), F.max("sid").alias("z")).filter("a < z").select("id", "a")
    ties = materialize(named.join(several, "id").select("a", F.col("sid").alias("b")).filter("a <> b").distinct(), "ties")
    nodes = in_play.union(ties.select("a")).union(ties.select("b")).distinct()
    labels = materialize(nodes.join(classes, "sid").select("sid", F.col("head").alias("comp")), "components")
    if not ties.isEmpty():
        labels = merge_components(labels, ties)
    least = least_agreement(percent / 100)

    def confirm(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose full sets are similar enough."""
        a, b = marks.toDF("a", "na", "sa"), marks.toDF("b", "nb", "sb")
        close = (pairs.distinct().join(a, "a").join(b, "b")
                 .filter((agreeing_lanes("sa", "sb") >= least) & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))
                 .select("a", "b"))
        # written, so that Spark knows how few they are before it shuffles the texts to meet them
        close = materialize(close, "close")
        full = close.join(texts.toDF("b", "body_b"), "b").join(texts.toDF("a", "body_a"), "a")
        return materialize(full.mapInPandas(_confirm(shingle, percent), "a long, b long"), "links")

    tested = None
    for turn in range(STAR_ROUNDS):
        members = buckets.join(labels, "sid")
        order = F.struct("comp", "sid") if turn == 0 else F.xxhash64(F.lit(turn), F.col("sid"), F.col("key"))
        centres = (members.groupBy("key")
                   .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min_by(F.struct("sid", "comp"), order).alias("c"))
                   .filter("lo < hi").select("key", F.col("c.sid").alias("a"), F.col("c.comp").alias("ca")))
        pairs = materialize(members.join(centres, "key").filter("comp <> ca").select("a", F.col("sid").alias("b")).distinct(), "pairs")
        links = confirm(pairs)
        tested = pairs if tested is None else tested.unionByName(pairs)
        if not links.isEmpty():
            labels = merge_components(labels, links)
    members = buckets.join(labels, "sid")
    # a bucket of two has one pair, and the first round has tested it
    split = (members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"))
             .filter("lo < hi AND size > 2").select("key"))
    open_ids = members.join(split, "key", "left_semi").select("sid", "comp").distinct()
    rest = _prefix_pairs(open_ids, texts, shingle, percent)
    done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = confirm(rest.join(done, ["a", "b"], "left_anti"))
    if not links.isEmpty():
        labels = merge_components(labels, links)
    found = named.join(labels, "sid", "left").groupBy("id").agg(F.min(F.coalesce("comp", "head")).alias("comp"))
    rows = sets.select("id", "n")
    rows = (rows.filter("id IS NOT NULL").join(found, "id", "left").select("id", "n", F.coalesce("comp", "id").alias("comp"))
            .unionByName(rows.filter("id IS NULL").withColumn("comp", F.lit(None).cast("long"))))
    return (rows.select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
