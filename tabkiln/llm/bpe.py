"""BPE encoding and decoding in batched NumPy merge rounds.

A text is cut at ASCII white space, which no token crosses; every distinct
piece of a batch is normalised, cut into words and encoded once.  The symbols
of all new words lie in one flat array.  A round looks up every adjacent pair
by binary search over the sorted pair keys, takes each word's pair of lowest
rank and merges its occurrences from left to right; words without a known
pair drop out.
"""

from __future__ import annotations

import hashlib
import json
import string
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.common import byte_batches, release

#: Pieces kept encoded in a Python worker; beyond it the memory starts anew (results do not depend on it).
CACHE_PIECES = 200_000

#: ASCII marks that are a word of their own after a letter; not those that begin a contraction or a special token.
MARKS = frozenset(c.encode() for c in string.punctuation if c not in "'<|>")

# The pre-tokenising pattern of the vocabulary files with word ends.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable bytes stand for themselves, the rest follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return [hidden.get(b, chr(b)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for a tokenizer file of the kind "BPE with word ends"."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.words = regex.compile(WORD_PATTERN)
        symbols = byte_symbols()
        self.inner = np.array([vocab.get(c, -1) for c in symbols], np.int64)
        self.last = np.array([vocab.get(c + self.end, -1) for c in symbols], np.int64)
        pairs = [tuple(p.split(" ")) if isinstance(p, str) else tuple(p) for p in model["merges"]]
        self.size = len(vocab)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        result = np.array([vocab[a + b] for a, b in pairs], np.int64)
        turn = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[turn], turn, result[turn]
        self.names = [self.tokens.get(i, "") for i in range(max(self.tokens) + 1)]
        self.pieces: dict[bytes, tuple[bytes, str]] = {}  # ids and decoded text; a piece of one word shares the word's
        self.words_ids: dict[str | int, tuple[bytes, str]] = {}  # of words and special tokens

    def normalise(self, text: str) -> str:
        """NFC, then lower case by character (a capital sigma has one lower case, wherever it stands)."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def cut(self, piece: bytes) -> list[str | int]:
        """Words of a piece, and the ids of special tokens that stand in it."""
        # a run of ASCII letters is one word, alone or before one mark; most pieces are such
        if piece.isalpha():
            return [piece.lower().decode("ascii")]
        if piece[:-1].isalpha() and piece[-1:] in MARKS:
            return [piece[:-1].lower().decode("ascii"), piece[-1:].decode("ascii")]
        text = piece.decode("utf-8", "replace")
        parts = self.split.split(text) if self.split and "<|" in text else [text]
        out: list[str | int] = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self.words.findall(self.normalise(part))
        return out

    def pairs(self, symbol: np.ndarray, word: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the known pairs, and rank, of each pair that begins at ``i``; the greatest number: not known."""
        j = np.minimum(i + 1, len(symbol) - 1)
        pair = np.where((word[i] == word[j]) & (j > i), symbol[i] * self.size + symbol[j], -1)
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return at, np.where(self.keys[at] == pair, self.ranks[at], np.iinfo(np.int64).max)

    def merge_rounds(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, and the offsets of each word's."""
        raw = [w.encode("utf-8") for w in words]
        size = np.array([len(r) for r in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbol = self.inner[flat]
        ends = np.cumsum(size) - 1
        symbol[ends] = self.last[flat[ends]]
        word = np.repeat(np.arange(len(words)), size)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        keep = symbol >= 0
        symbol, word = symbol[keep], word[keep]
        none = np.iinfo(np.int64).max
        at, rank = self.pairs(symbol, word, np.arange(len(symbol)))
        while len(symbol):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lowest = np.minimum.reduceat(rank, first)
            last = np.append(first[1:], len(symbol))
            more = lowest < none
            still = np.repeat(more, last - first)
            done.append((word[~still], symbol[~still]))
            if not more.any():
                break
            hit = np.flatnonzero((rank < none) & (rank == np.repeat(lowest, last - first)))
            # in a run of equal symbols only every second pair is free
            run = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(hit) > 1]), np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            symbol[hit] = self.merged[at[hit]]
            still[hit + 1] = False
            symbol, word, at, rank = symbol[still], word[still], at[still], rank[still]
            # only the pairs that hold a new symbol are looked up again
            new = (np.cumsum(still) - 1)[hit]
            new = np.concatenate([new, new[new > 0] - 1])
            at[new], rank[new] = self.pairs(symbol, word, new)
        word, symbol = (np.concatenate(x) for x in zip(*done)) if done else (word, symbol)
        turn = np.argsort(word, kind="stable")
        return symbol[turn], np.searchsorted(word[turn], np.arange(len(words) + 1))

    def decode(self, ids) -> str:
        """Tokens as they stand in the vocabulary, joined by spaces; unknown ids are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)

    def learn(self, pieces: set[bytes]) -> None:
        """Encode the pieces that are not known yet."""
        if len(self.pieces) > CACHE_PIECES:
            self.pieces = {}
        if len(self.words_ids) > CACHE_PIECES:
            self.words_ids = {}
        cuts = {p: self.cut(p) for p in pieces.difference(self.pieces)}
        done, known, names = self.pieces, self.words_ids, self.names
        words = set().union(*cuts.values())
        new = [w for w in words.difference(known) if isinstance(w, str)]
        if new:
            symbols, offsets = self.merge_rounds(new)
            packed, listed, offsets = symbols.astype("<u4").tobytes(), symbols.tolist(), offsets.tolist()
            for w, s, e in zip(new, offsets, offsets[1:]):
                known[w] = packed[4 * s : 4 * e], names[listed[s]] if e == s + 1 else " ".join([names[i] for i in listed[s:e]])
        for i, name in ((i, n) for n, i in self.special.items()):
            known.setdefault(i, (i.to_bytes(4, "little"), name))
        for p, c in cuts.items():
            if len(c) == 1:
                done[p] = known[c[0]]
            elif len(c) == 2:
                (a, d), (b, e) = known[c[0]], known[c[1]]
                done[p] = a + b, f"{d} {e}" if d and e else d or e
            else:
                parts = [known[w] for w in c]
                done[p] = b"".join([a for a, _ in parts]), " ".join([d for _, d in parts if d])

    def encode(self, bodies: list[bytes]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids as little-endian 32-bit integers, and their decoded text."""
        texts = [b.split() for b in bodies]
        self.learn(set().union(*texts))
        for t in texts:
            parts = list(map(self.pieces.__getitem__, t))
            yield b"".join([a for a, _ in parts]), " ".join([d for _, d in parts if d])


_MODELS: dict[str, WordBpe] = {}


def model(path: str) -> WordBpe:
    if path not in _MODELS:
        _MODELS[path] = WordBpe(path)
    return _MODELS[path]


def _mapped(df: DataFrame, id_col: str, text_col: str, run, schema: str) -> DataFrame:
    """``run`` over (id, body); ids pass it as strings, since pandas rounds large numbers beside NULL."""
    found = (df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("body"))
             .mapInPandas(run, f"id string, {schema}"))
    return found.withColumn("id", F.col("id").cast(df.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded): token ids of whole texts and the text they decode to.

    NULL and empty texts have no ids.  ``path`` names the vocabulary file, which every node has.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = model(path)
        for pdf in batches:
            bodies = [b or b"" for b in pdf["body"]]
            for lo, hi in byte_batches(bodies):
                got = list(bpe.encode(bodies[lo:hi]))
                yield pd.DataFrame({"id": pdf["id"].iloc[lo:hi].array, "ids": [np.frombuffer(a, "<u4").astype(np.int32) for a, _ in got],
                                    "decoded": [d for _, d in got]})
        release()

    return _mapped(df, id_col, text_col, run, "ids array<int>, decoded string")


def encode_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256), digested where the text is encoded."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = model(path)
        for pdf in batches:
            bodies = [b or b"" for b in pdf["body"]]
            for lo, hi in byte_batches(bodies):
                rows = [(len(a) // 4, hashlib.sha256(a).hexdigest(), hashlib.sha256(d.encode("utf-8")).hexdigest()) for a, d in bpe.encode(bodies[lo:hi])]
                n, a, d = zip(*rows)
                yield pd.DataFrame({"id": pdf["id"].iloc[lo:hi].array, "n_tokens": n, "ids_sha256": a, "decoded_sha256": d})
        release()

    return _mapped(df, id_col, text_col, run, "n_tokens long, ids_sha256 string, decoded_sha256 string")
