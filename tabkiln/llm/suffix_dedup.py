"""Repeated-substring removal over the Burrows-Wheeler transform of a document collection.

Texts are cut into chunks that meet by content (``chunks``).  In a task, the
chunks form a collection whose transform is built column-wise: each round
every document inserts its next symbol, from right to left, at the place that
the ranks of the round before give, and the common prefixes with both
neighbours are brought up to date.  A symbol is ``SYMBOL`` bytes, and a chunk
enters as ``SYMBOL`` documents, one per phase, so every byte position starts
one suffix while the number of rounds stays small.  Neighbours that share
``window / SYMBOL`` symbols hold an equal window.

The arrays of a collection are rewritten front to back each round, as the
external files of the disk-based construction are; collections are bounded
(``Plan.task_bytes`` and ``Plan.group_limit``), so they stay in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.chunks import Plan, drop_ranges, merge_ranges, repeated_windows
from tabkiln.llm.common import mix, row_id

WINDOW = 400
GRAM = 128
SYMBOL = 40
_LOW = np.int64(0xFFFFFFFF)


def collection_bwt(text: np.ndarray, ends: np.ndarray, cap: int = 250) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column-wise construction for documents laid end to end in ``text``.

    ``text`` holds positive symbols and one 0 after each document; ``ends`` are
    the positions of these zeros, which count as different from each other.
    Returns the suffixes in order (their positions), the transform (the symbol
    before each suffix, 0 at a document's start) and the common prefix with the
    suffix before, counted up to ``cap``.
    """
    counted = np.min_scalar_type(cap)
    m = len(ends)
    starts = np.concatenate([[0], ends[:-1] + 1])
    where = ends.astype(np.int64).copy()             # position of each document's newest suffix
    rank = np.arange(m, dtype=np.int64)              # its place in the order
    key = np.arange(m, dtype=np.int64)               # first symbol << 32 | rank of the rest
    source = where.copy()
    lcp = np.zeros(m, counted)
    active = np.flatnonzero(where > starts)
    while len(active):
        n, k = len(key), len(active)
        c = text[where[active] - 1].astype(np.int64)
        new = (c << 32) | rank[active]
        turn = np.argsort(new, kind="stable")
        active, new = active[turn], new[turn]
        at = np.searchsorted(key, new)
        place = at + np.arange(k)
        shift = np.cumsum(np.bincount(at, minlength=n + 1))[:n]
        moved = np.arange(n) + shift
        tail = new & _LOW                            # ranks in the order before this round
        old_lcp, old_tail = lcp, np.empty(n + k, np.int64)
        old_tail[moved], old_tail[place] = key & _LOW, tail
        key2, source2, lcp2 = np.empty(n + k, np.int64), np.empty(n + k, np.int64), np.empty(n + k, counted)
        key2[moved], key2[place] = key + shift[key & _LOW], new + shift[tail]
        source2[moved], source2[place] = source, where[active] - 1
        lcp2[moved] = lcp
        lcp2[place] = _common(text, source2, key2, old_tail, old_lcp, place, cap)
        after = place[place + 1 < n + k] + 1
        lcp2[after] = _common(text, source2, key2, old_tail, old_lcp, after, cap)
        key, source, lcp = key2, source2, lcp2
        where[active] -= 1
        rank[active] = place
        active = active[where[active] > starts[active]]
    begin = np.zeros(len(text), bool)
    begin[starts] = True
    begins = begin[source]
    bwt = np.where(begins, 0, text[np.maximum(source - 1, 0)])
    return source, bwt, lcp


def _common(text, source, key, tail, old_lcp, at, cap):
    """Common prefixes of the suffixes at ``at`` with the ones before them: one more than that of their
    rests where those were neighbours, else by comparing symbols."""
    before = np.maximum(at - 1, 0)
    same = (at > 0) & ((key[at] >> 32) == (key[before] >> 32)) & ((key[at] >> 32) > 0)
    near = same & (tail[at] - tail[before] == 1)
    out = np.where(near, np.minimum(old_lcp[tail[at] * near].astype(np.int64) + 1, cap), 0)
    i = np.flatnonzero(same & ~near)
    a, b, d = source[at[i]], source[before[i]], 0
    while len(i) and d < cap:
        x = text[a + d]
        keep = (x == text[b + d]) & (x > 0)
        out[i[~keep]] = d
        i, a, b, d = i[keep], a[keep], b[keep], d + 1
    out[i] = cap
    return out


def phase_documents(bodies: list[bytes], symbol: int = SYMBOL) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts as ``symbol`` documents each.  Returns text, ends, and for each position its body and byte offset."""
    raw = np.frombuffer(b"".join(bodies) + bytes(symbol), np.uint8)
    size = np.array([len(b) for b in bodies], np.int64)
    off = np.concatenate([[0], np.cumsum(size)])
    wide, have = raw.astype(np.uint64), 1
    while have < 8:
        wide = (wide[:-have] << np.uint64(8 * have)) | wide[have:]
        have *= 2
    code = wide[: off[-1]]
    for k in range(8, symbol, 8):
        code = mix(code) * np.uint64(31) + wide[k : k + off[-1]]
    ids, _ = pd.factorize(code)  # any order of the symbols will do
    layouts: dict[int, np.ndarray] = {}
    for n in set(size.tolist()):
        at = np.arange(max(n - symbol + 1, 0))
        layouts[n] = np.concatenate([x for t in range(min(symbol, len(at))) for x in (at[t::symbol], [-1])] or [at])
    byte = np.concatenate([layouts[n] for n in size.tolist()] or [np.zeros(0, np.int64)])
    body = np.repeat(np.arange(len(bodies)), [len(layouts[n]) for n in size.tolist()])
    text = np.zeros(len(byte), np.int64)
    text[byte >= 0] = ids[(off[body] + byte)[byte >= 0]] + 1
    return text, np.flatnonzero(byte < 0), body, byte


def bwt_matcher(window: int, symbol: int = SYMBOL):
    """Window starts of each body whose window occurs again in the collection (or in a body of weight > 1)."""
    if window % symbol:
        raise ValueError("the window must be a multiple of the symbol length")

    def match(bodies: list[bytes], weights: list[int]) -> list[list[tuple[int, int]]]:
        text, ends, body, byte = phase_documents(bodies, symbol)
        source, _, lcp = collection_bwt(text, ends, window // symbol)
        hit = np.flatnonzero(lcp >= window // symbol)
        again = np.unique(np.concatenate([source[hit], source[hit - 1]]))
        of, at = body[again], byte[again]
        turn = np.lexsort((at, of))
        of, at = of[turn], at[turn]
        new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1)])) if len(of) else []
        last = np.concatenate([new[1:], [len(of)]]) - 1 if len(of) else []
        out: list[list[tuple[int, int]]] = [[] for _ in bodies]
        for i, j in zip(new, last):
            out[of[i]].append((int(at[i]), int(at[j]) + 1))
        for i, n in enumerate(weights):
            if n > 1:
                out[i] = [(0, len(bodies[i]) - window + 1)]
        return out

    return match


_SCHEMA = "n_bytes long, n_removed long, n_spans long, kept binary"


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM, symbol: int = SYMBOL) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): the UTF-8 bytes outside every repeated ``window``-byte string.

    A string counts as repeated if it starts at two places of the column, in
    one text or in two; texts are judged as they come in.  NULL texts count as
    empty; texts below ``window`` bytes stay whole; equal rows get equal
    results; other columns are not carried.
    """
    plan = Plan(words=False, window=window, gram=gram)
    found = repeated_windows(df, id_col, text_col, plan, bwt_matcher(window, symbol))
    rows = df.select(F.col(id_col).cast("string").alias("id"), *row_id(id_col, text_col), F.col(text_col).cast("binary").alias("body"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for body, ranges in zip(pdf["body"], pdf["ranges"]):
                body, spans = body or b"", merge_ranges(ranges)
                kept = b"".join(drop_ranges(body, spans))
                out.append((len(body), len(body) - len(kept), len(spans), kept))
            n, removed, spans, kept = zip(*out) if out else ((), (), (), ())
            yield pd.DataFrame({"id": pdf["id"], "n_bytes": n, "n_removed": removed, "n_spans": spans, "kept": kept})

    kept = rows.join(found, ["r1", "r2"], "left").select("id", "body", "ranges").mapInPandas(cut, f"id string, {_SCHEMA}")
    return kept.withColumn("id", F.col("id").cast(df.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def repeat_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``remove_repeats`` with the kept bytes as their SHA-256."""
    kept = remove_repeats(df, id_col, text_col, **options)
    return kept.select(id_col, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
