"""Shared helpers: scratch tables in the shared folder, byte tokenising and hashing in NumPy.

Words are runs of bytes outside 0x20 and 0x09-0x0D (``bytes.split()``); all
hashes are 64-bit and depend on content alone, so they agree between tasks.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkiln.session import checkpoint_dir

#: Bytes of text handled at once inside a task; a longer text is one batch of its own.
BATCH_BYTES = 200_000

_RNG = np.random.default_rng(20240917)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_RATIO = 0x9E3779B97F4A7C15
_INVERSE = pow(_RATIO, -1, 2**64)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_id(id_col: str, text_col: str) -> list[Column]:
    """Two longs that name a row by its content (equal rows share them, and share every result)."""
    return [F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col)).alias("r1"),
            F.xxhash64(F.lit(2), F.col(text_col), F.col(id_col)).alias("r2")]


def fresh_names(df: DataFrame, *stems: str) -> list[str]:
    """A name for each stem that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in (s + "_" * k for k in range(len(taken) + 1)) if n.lower() not in taken) for s in stems]


def release() -> None:
    """Give what this worker has freed back to the machine; a reused worker else keeps its largest batch's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def byte_batches(bodies: Sequence[bytes | None], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts hold about ``limit`` bytes together."""
    lo, size = 0, 0
    for i, b in enumerate(bodies):
        n = len(b) if b else 0
        if i > lo and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(bodies):
        yield lo, len(bodies)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX[0]
    h ^= h >> np.uint64(33)
    h *= _MIX[1]
    h ^= h >> np.uint64(33)
    return h


class Powers:
    """Powers of an odd ratio and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_RATIO, k, 2**64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(_INVERSE, k, 2**64))])
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``range_hash`` reads the hash of any slice of ``codes``."""
    up, _ = POWERS.to(len(codes))
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up, out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = POWERS.to(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def gram_hash(prefix: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` codes, from their ``prefix_hash``."""
    _, down = POWERS.to(len(prefix))
    n = max(len(prefix) - length, 0)
    return mix((prefix[length:] - prefix[:n]) * down[:n])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(bodies: Sequence[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, and the offsets of each text's words."""
    raw = b" ".join([b or b"" for b in bodies]) + b" "
    if lower:
        raw = raw.lower()
    data = np.frombuffer(raw, np.uint8)
    lens = np.fromiter((len(b or b"") + 1 for b in bodies), np.int64, len(bodies))
    word = ~_SPACE[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]  # the text ends in a space
    # a byte's share is a mixed hash of it and its place in the word: no word is a polynomial, whose hashes modulo a
    # power of two agree for long regular words
    hashes = np.zeros(0, np.uint64)
    if len(start):
        first = start[0]
        place = np.arange(first, len(data)) - np.repeat(start, np.diff(np.append(start, len(data))))
        share = (BYTE_CODE[data[first:]] ^ (place.astype(np.uint64) * np.uint64(_RATIO))) * _MIX[0]
        share ^= share >> np.uint64(32)
        share *= _MIX[1]
        share[~word[first:]] = 0
        hashes = mix(np.add.reduceat(share, start - first) + (end - start).astype(np.uint64))
    offsets = np.concatenate([[0], np.searchsorted(start, np.cumsum(lens))])
    return hashes, offsets
