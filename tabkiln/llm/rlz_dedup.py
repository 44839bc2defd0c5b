"""Repeated-passage removal by relative Lempel-Ziv parsing.

The reference is the corpus itself, cut into blocks: a block holds the chunks
that meet by content (``chunks``), and is indexed by its word suffixes.  Each
chunk is parsed greedily against its block: a factor is the longest run of
words from the current place that starts elsewhere too.  A factor of at least
``window`` words is a duplicate span.  Windows that cross a factor's end are
looked up one by one, so no repeated window is missed at a boundary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.chunks import Plan, drop_ranges, merge_ranges, repeated_windows
from tabkiln.llm.common import fresh_names, row_id

WINDOW = 35
GRAM = 8


class BlockIndex:
    """Longest other occurrence of the run that starts at each word of a block.

    ``words`` are the block's texts laid end to end, each followed by a word of
    its own; lengths are counted up to a power of two above ``reach``.
    """

    def __init__(self, words: np.ndarray, reach: int) -> None:
        ranks = [words]
        while 1 << (len(ranks) - 1) < reach:
            step, r = 1 << (len(ranks) - 1), ranks[-1]
            rest = np.zeros(len(r), np.int64)
            rest[:-step] = r[step:] + 1
            ranks.append(np.unique(r * np.int64(len(r) + 2) + rest, return_inverse=True)[1])
        order = np.argsort(ranks[-1], kind="stable")
        common = np.zeros(len(words) + 1, np.int64)
        common[1:-1] = self._common(ranks, order[1:], order[:-1])
        self.longest = np.empty(len(words), np.int64)
        self.longest[order] = np.maximum(common[:-1], common[1:])

    @staticmethod
    def _common(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n, have = len(ranks[0]), np.zeros(len(a), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            x, y = a + have, b + have
            ok = (x < n) & (y < n)
            ok[ok] = ranks[level][x[ok]] == ranks[level][y[ok]]
            have += ok << level
        return have


def parse(longest: list[int], window: int) -> list[tuple[int, int]]:
    """Ranges of window starts that occur again, from one text's greedy factors and the checks at their ends."""
    out: list[tuple[int, int]] = []

    def add(s: int, e: int) -> None:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))

    n, at = len(longest), 0
    while at + window <= n:
        end = at + max(1, longest[at])
        if longest[at] >= window:
            add(at, end - window + 1)
        for q in range(max(at + 1, end - window + 1), min(end, n - window + 1)):  # windows across the boundary
            if longest[q] >= window:
                add(q, q + 1)
        at = end
    return out


def rlz_matcher(window: int):
    def match(bodies: list[bytes], weights: list[int]) -> list[list[tuple[int, int]]]:
        texts = [b.split() for b in bodies]
        ids: dict[bytes, int] = {}
        flat: list[int] = []
        ends = -1
        starts = []
        for t, n in zip(texts, weights):
            for copy in range(2 if n > 1 else 1):  # copies enter twice, so that each has another occurrence
                if not copy:
                    starts.append(len(flat))
                flat += [ids.setdefault(w, len(ids)) for w in t]
                flat.append(ends)
                ends -= 1
        words = np.array(flat, np.int64)
        words[words < 0] = len(ids) - 1 - words[words < 0]
        longest = BlockIndex(words, 2 * window).longest.tolist()
        return [parse(longest[s : s + len(t)], window) for s, t in zip(starts, texts)]

    return match


def remove_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    gram: int = GRAM) -> DataFrame:
    """(r1, r2, id, n_words, n_removed, kept): the words outside every repeated window of ``window`` words.

    Words are runs outside 0x20 and 0x09-0x0D, compared as they are; ``kept``
    joins the words that stay by one space.  A window counts as repeated if it
    starts at two places of the column, in one text or in two.  NULL texts have
    no words; shorter texts stay whole; equal rows get equal results.
    """
    plan = Plan(words=True, window=window, gram=gram)
    found = repeated_windows(df, id_col, text_col, plan, rlz_matcher(window))
    rows = df.select(F.col(id_col).cast("string").alias("id"), *row_id(id_col, text_col), F.col(text_col).cast("binary").alias("body"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for body, ranges in zip(pdf["body"], pdf["ranges"]):
                words = (body or b"").split()
                kept = [w for part in drop_ranges(words, merge_ranges(ranges)) for w in part]
                out.append((len(words), len(words) - len(kept), b" ".join(kept)))
            n, removed, kept = zip(*out) if out else ((), (), ())
            yield pd.DataFrame({"r1": pdf["r1"], "r2": pdf["r2"], "id": pdf["id"], "n_words": n, "n_removed": removed, "kept": kept})

    kept = (rows.join(found, ["r1", "r2"], "left").select("r1", "r2", "id", "body", "ranges")
            .mapInPandas(cut, "r1 long, r2 long, id string, n_words long, n_removed long, kept binary"))
    return kept.withColumn("id", F.col("id").cast(df.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def cut_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str | None = None,
              window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``df`` with the repeated passages cut out of ``text_col``, and ``n_chars_col`` following it.

    A text that loses words becomes its other words joined by one space; all other texts stay to the byte.
    """
    found = repeated_windows(df, id_col, text_col, Plan(words=True, window=window, gram=gram), rlz_matcher(window))
    n1, n2, spans, body = fresh_names(df, "__r1", "__r2", "__ranges", "__cut")
    found = found.toDF(n1, n2, spans)

    @F.pandas_udf("string")
    def cut(bodies: pd.Series, ranges: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else b" ".join(w for part in drop_ranges(b.split(), merge_ranges(r)) for w in part).decode("utf-8", "replace")
                          for b, r in zip(bodies, ranges)], dtype=object)

    r1, r2 = row_id(id_col, text_col)
    out = df.select("*", r1.alias(n1), r2.alias(n2)).join(found, [n1, n2], "left")
    hit = F.col(spans).isNotNull()
    out = out.withColumn(body, cut(F.when(hit, F.col(text_col).cast("binary")), F.col(spans)))
    changed = {text_col: F.when(hit, F.col(body)).otherwise(F.col(text_col))}
    if n_chars_col:
        changed[n_chars_col] = F.when(hit, F.length(body).cast(df.schema[n_chars_col].dataType)).otherwise(F.col(n_chars_col))
    return out.withColumns(changed).select(df.columns)


def passage_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``remove_passages`` with the kept words as their SHA-256."""
    kept = remove_passages(df, id_col, text_col, **options)
    return kept.select(id_col, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
