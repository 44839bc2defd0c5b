"""Runs of words that repeat with a period, found by block convolution.

At scale B (1, 2, 4, ...) the texts of a batch are cut into blocks of B words.
A run of period q in [B, 2B) that is at least four periods long holds a whole
block whose copy follows q words later.  The sum of squared differences
between a block and the words d = B .. 2B - 1 places after it is

    sum x^2 + sum y^2 - 2 (x correlated with y),

the correlation being an integer number theoretic transform: exact modulo a
prime, so a true copy always gives zero.  Each zero's distance seeds an
extension to both sides, word by word; what is long enough is a run, and a
zero that came by chance is refused there.

A batch's words are numbered as words, not by hash.  Blocks are transformed in
slabs, so memory follows the longest text alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.common import byte_batches

#: A run has at least so many periods, and words.
MIN_PERIODS, MIN_WORDS = 4, 6
#: Words transformed at once.
SLAB = 1 << 17

# A prime below 2^31 of the form c * 2^27 + 1, and one of its primitive roots.
PRIME, ROOT = 2013265921, 31
_P = np.uint64(PRIME)


@lru_cache(maxsize=64)
def _twiddles(size: int, inverse: bool) -> np.ndarray:
    """The first ``size`` / 2 powers of a root of unity of order ``size``."""
    root = pow(ROOT, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, -1, PRIME)
    out = np.ones(1, np.uint64)
    while len(out) < size // 2:
        out = np.concatenate([out, out * np.uint64(pow(root, len(out), PRIME)) % _P])
    return out


@lru_cache(maxsize=32)
def _negated(size: int) -> np.ndarray:
    """Where the transform at minus a frequency stands, frequencies being in bit-reversed order."""
    reverse = np.zeros(1, np.int64)
    while len(reverse) < size:
        reverse = np.concatenate([reverse * 2, reverse * 2 + 1])
    return reverse[-reverse % size]


def transform(a: np.ndarray) -> np.ndarray:
    """Transform of every row (a power of two long); frequencies come out in bit-reversed order."""
    rows, size = a.shape
    step = size
    while step > 1:
        a = a.reshape(rows, size // step, 2, step // 2)
        left, right = a[:, :, 0], a[:, :, 1]
        out = np.empty_like(a)
        out[:, :, 0] = (left + right) % _P
        out[:, :, 1] = (left + _P - right) * _twiddles(step, False) % _P
        a, step = out, step // 2
    return a.reshape(rows, size)


def restore(a: np.ndarray) -> np.ndarray:
    """Rows from their transforms, times the length of a row."""
    rows, size = a.shape
    step = 2
    while step <= size:
        a = a.reshape(rows, size // step, 2, step // 2)
        left, right = a[:, :, 0], a[:, :, 1] * _twiddles(step, True) % _P
        out = np.empty_like(a)
        out[:, :, 0] = (left + right) % _P
        out[:, :, 1] = (left + _P - right) % _P
        a, step = out, step * 2
    return a.reshape(rows, size)


def block_copies(flat: np.ndarray, size: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) wherever one of the first ``count`` blocks of ``size`` words has its copy ``size`` to
    2 ``size`` - 1 words after it, in order of places.

    ``flat`` holds numbers below 2^31 and reaches two blocks beyond the last; a few pairs may be no copies.
    """
    squares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * flat % _P, dtype=np.uint64)])
    slab = max(1, SLAB // size)
    turn = _twiddles(2 * size, False)
    back = _twiddles(2 * size, True)
    scale = np.uint64(pow(2 * size, -1, PRIME) * 2 % PRIME)
    minus = _negated(size)
    odd_minus = (_negated(2 * size)[size:] - size) if size > 1 else np.zeros(1, np.int64)
    places, distances = [], []
    for lo in range(0, count, slab):
        n = min(slab, count - lo)
        x = flat[lo * size : (lo + n + 2) * size].reshape(n + 2, size)
        # a row of 2 B places, the block and then zeros, has the block's transform at even frequencies, and that of
        # the block times the root's powers at odd ones
        even, odd = transform(x), transform(x * turn % _P)
        # the words after a block are the next two blocks; moving the second by B turns the sign of odd frequencies
        even = (even[1:-1] + even[2:]) % _P * even[:-2][:, minus] % _P
        odd = (odd[1:-1] + _P - odd[2:]) % _P * odd[:-2][:, odd_minus] % _P
        twice = (restore(even) + restore(odd) * back) % _P * scale % _P
        start = np.arange(lo, lo + n) * size
        at = start[:, None] + np.arange(size, 2 * size)
        own = squares[start + size] - squares[start]
        total = (own[:, None] + squares[at + size] - squares[at]) % _P
        row, d = np.nonzero(total == twice)
        places.append(start[row])
        distances.append(d + size)
    return np.concatenate(places), np.concatenate(distances)


def _extent(flat: np.ndarray, at: int, step: int, d: int) -> int:
    """How many words from ``at`` on, forward or backward, equal those ``d`` places after them."""
    total, width = 0, 32
    while True:
        lo, hi = (at + total, at + total + width) if step > 0 else (max(at - total - width + 1, 0), at - total + 1)
        hi = min(hi, len(flat) - d)
        if hi <= lo:
            return total
        differ = flat[lo:hi] != flat[lo + d : hi + d]
        if differ.any():
            return total + int(differ.argmax() if step > 0 else differ[::-1].argmax())
        total += hi - lo
        width *= 2


def runs_of(texts: Sequence[Sequence[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of every text, a list of words, by start and period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    numbers: dict[bytes, int] = {}
    flat: list[int] = []
    starts: list[int] = []
    ends: list[int] = []
    for i in order:
        starts.append(len(flat))
        flat += [numbers.setdefault(w, len(numbers)) for w in texts[i]]
        ends.append(len(flat))
        flat.append(-1)
    longest = len(texts[order[0]]) if order else 0
    # numbers of their own stand between texts and after the last, so that no run crosses them
    room = np.concatenate([np.array(flat, np.int64), np.full(2 + longest, -1)])
    marks = np.flatnonzero(room < 0)
    room[marks] = len(numbers) + np.arange(len(marks))
    words = room.astype(np.uint64)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    known: list[tuple[int, int, int]] = []  # start, end, period in the flat order
    size = 1
    while True:
        wide = sum(len(texts[i]) >= max(MIN_WORDS, MIN_PERIODS * size) for i in order)
        if not wide:
            break
        place, distance = block_copies(words, size, -(-ends[wide - 1] // size))
        fresh = np.ones(len(place), bool)
        for s, e, q in known:  # a copy inside a run, at a multiple of its period, is that run
            lo, hi = np.searchsorted(place, [s, e])
            fresh[lo:hi] &= (place[lo:hi] + size + distance[lo:hi] > e) | (distance[lo:hi] % q != 0)
        seen: dict[int, int] = {}  # the end of the last stretch of each distance
        for at, d in zip(place[fresh].tolist(), distance[fresh].tolist()):
            if at < seen.get(d, 0):
                continue
            right = at + _extent(room, at, 1, d)
            seen[d] = right
            left = at - _extent(room, at - 1, -1, d)
            length = right + d - left
            if right > at and length >= max(MIN_WORDS, MIN_PERIODS * d):
                known.append((left, left + length, d))
                text = int(np.searchsorted(starts, left, side="right")) - 1
                found[order[text]].append((left - starts[text], length, d))
        size *= 2
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def collapse(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """The words outside every run, and each run's first period where no other run takes it."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs array<(start, length, period)>, collapsed) for every row of ``df``.

    Words are runs outside 0x20 and 0x09-0x0D, numbered from 0.  A run is a
    stretch of smallest period q, of at least ``MIN_PERIODS`` * q and
    ``MIN_WORDS`` words, that no neighbouring word prolongs; runs come by start,
    then period.  ``collapsed`` joins by one space the words that stay when each
    run keeps its first q words.  NULL and empty texts have no words and no
    runs; ids may be NULL, repeat and be of any type.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bodies = list(pdf["body"])
            for lo, hi in byte_batches(bodies):
                texts = [(b or b"").split() for b in bodies[lo:hi]]
                runs = runs_of(texts)
                yield pd.DataFrame({
                    "id": pdf["id"].iloc[lo:hi].array, "n_words": [len(t) for t in texts],
                    "runs": [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs],
                    "collapsed": [b" ".join(collapse(t, r) if r else t) for t, r in zip(texts, runs)]})

    found = (df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("body"))
             .mapInPandas(run, "id string, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"))
    return found.select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), "n_words", "runs",
                        F.col("collapsed").cast("string").alias("collapsed"))


def run_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) for every row of ``df``.

    The run shown has the greatest length / period; of equal ones the smallest start, then the smallest period.
    """
    better = "(b.length * x.period > x.length * b.period)"
    best = F.expr(f"aggregate(runs, cast(null as struct<start:long,length:long,period:long>), "
                  f"(x, b) -> if(x is null or {better}, b, x))")  # runs come by start and period: ties stay with the first
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    found = periodic_runs(df, id_col, text_col).select("*", best.alias("best"))
    return found.select(
        id_col, F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
