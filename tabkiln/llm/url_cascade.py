"""URL rules by Bloom filter cascades, in DataFrame expressions alone.

A cascade answers exactly whether a key of the corpus is listed: level 1
encodes the listed keys, level 2 the other keys of the corpus that level 1
lets through, level 3 the listed keys that level 2 lets through, and so on
until nothing slips through.  A key's answer is the parity of the first level
that does not hold it.  Deciding a URL needs no join: its candidate keys (host
suffix and path prefix) are tested inside the row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.common import materialize

MAX_LEVELS = 64


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    words: tuple[int, ...]


def _position(key: Column, number: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(number * 64 + i)), F.lit(bits).cast("long"))


def build_level(keys: DataFrame, n: int, number: int, rate: float) -> Level:
    """A Bloom filter of the ``n`` keys with the given false-positive rate, its bits or-ed in one aggregation."""
    hashes = max(1, round(-math.log2(rate)))
    bits = 64 * math.ceil(max(64.0, n * hashes / math.log(2)) / 64)
    at = F.explode(F.array(*[_position(F.col("key"), number, i, bits) for i in range(hashes)]))
    rows = (keys.select(at.alias("p")).groupBy(F.floor(F.col("p") / 64).alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("m")).collect())
    words = [0] * (bits // 64)
    for r in rows:
        words[r["w"]] = r["m"]
    return Level(number, bits, hashes, tuple(words))


def holds(level: Level, key: Column) -> Column:
    words, test = F.array(*[F.lit(w).cast("long") for w in level.words]), None
    for i in range(level.hashes):
        p = _position(key, level.number, i, level.bits)
        word = F.element_at(words, (F.floor(p / 64) + 1).cast("int"))
        bit = F.call_function("shiftrightunsigned", word, (p % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
        test = bit if test is None else test & bit
    return test


def build_cascade(listed: DataFrame, universe: DataFrame, salt: int = 0) -> list[Level]:
    """Levels for the ``listed`` keys against the complete ``universe`` of keys (column ``key``).

    The size is bounded by the listed keys and the logarithm of the universe, not by the universe.
    """
    n, u = listed.count(), universe.count()
    if not n:
        return []
    inside, outside = listed, universe.join(listed, "key", "left_anti")
    rate, levels = min(0.5, n * math.sqrt(0.5) / max(u, 1)), []
    for depth in range(MAX_LEVELS):
        levels.append(build_level(inside, n, salt + depth, rate))
        through = materialize(outside.filter(holds(levels[-1], F.col("key"))), "cascade")
        n, rate = through.count(), 0.5
        if not n:
            return levels
        inside, outside = through, inside
    raise RuntimeError(f"no exact cascade in {MAX_LEVELS} levels")


def member(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed."""
    answer = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        answer = F.when(~holds(levels[i], key), F.lit(i % 2 == 1)).otherwise(answer)
    return answer


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    host = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tail = F.substring(rest, F.length(raw) + 1, F.length(rest))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(tail, r"^[^?#]*", 0), F.lit(""))


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every host suffix at a label's start, with every prefix of the path that is as long as some rule's."""
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    cuts = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths])
    cuts = F.filter(cuts, lambda c: c.isNotNull())
    return F.flatten(F.transform(hosts, lambda h: F.transform(cuts, lambda c: F.concat(h, c))))


def judge(df: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with host, path, rule and verdict.

    ``rules`` are (verdict, host, path) with verdict allow or block.  A rule fits
    its host and all subdomains if the path starts with the rule's; of several
    the longest (host and path together; at a tie the longer host) decides, and
    without one the verdict is ``default``: the URL's keys are on no list.  NULL
    URLs and URLs without ``://`` have an empty host and path.  Two rules for
    one host and path raise.  Columns of ``df`` with the result's names are replaced.
    """
    if len({h + p for _, h, p in rules}) < len(rules) or {v for v, _, _ in rules} - {"allow", "block"}:
        raise ValueError("rules must be unique by host and path, with verdict allow or block")
    spark = df.sparkSession
    lengths = sorted({len(p) for _, _, p in rules})
    host, path = host_and_path(F.col(url_col))
    out = df.withColumns({"host": host, "path": path})
    short = out.select("host", F.substring("path", 1, max([0, *lengths])).alias("path")).distinct()
    universe = materialize(short.select(F.explode(candidate_keys(F.col("host"), F.col("path"), lengths)).alias("key")).distinct(), "url-keys") if rules else None
    tests = {}
    for salt, verdict in ((0, "allow"), (1000, "block")):
        listed = [(h + p,) for v, h, p in rules if v == verdict]
        if listed:
            tests[verdict] = build_cascade(spark.createDataFrame(listed, "key string"), universe, salt)
    if not tests:
        return out.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})

    def verdict(key: Column) -> Column:
        answer = F.lit(None).cast("string")
        for name, levels in tests.items():
            answer = F.when(member(levels, key), F.lit(name)).otherwise(answer)
        return answer

    fits = F.transform(candidate_keys(F.col("host"), F.col("path"), lengths), lambda k: F.struct(
        F.length(k).alias("n"), F.length(F.regexp_extract(k, r"^[^/]*", 0)).alias("h"), k.alias("rule"), verdict(k).alias("verdict")))
    best = F.array_max(F.filter(fits, lambda f: f["verdict"].isNotNull()))
    return out.withColumn("rule", best).withColumns({"rule": F.col("rule.rule"), "verdict": F.coalesce("rule.verdict", F.lit(default))})
