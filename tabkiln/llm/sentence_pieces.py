"""SentencePiece (BPE model) encoding and decoding by a table of distinct chunks.

A text is marked as the model wants it: a word mark before it and in place of
every space.  No piece of the vocabulary goes on past a mark that follows
another character, so no merge crosses such a place: a chunk (marks, then
characters up to the next mark) is cut into pieces alone.  A batch's distinct
chunks that are not in the table yet are segmented once each: all of them
together, one merge a chunk and round, and very long ones alone with a heap of
adjacent pairs.  A text's ids are the table's, joined by position.

The table lives in a Python worker and holds at most ``TABLE_CHUNKS`` chunks;
results do not depend on what it holds.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections import ChainMap
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.common import byte_batches

TABLE_CHUNKS = 1_000_000
#: Longer chunks are segmented alone, where they stand, and not kept.
KEPT_CHARS = 48
#: Bytes of text whose distinct chunks are segmented together.
BATCH = 1_000_000

MARK = "▁"

# Field numbers of the model file and kinds of pieces.
FIELD_PIECE, FIELD_TRAINER, FIELD_NORMALISER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 2, 3
TRAINER_KIND, TRAINER_SUFFIX_MARK, TRAINER_BYTES, TRAINER_UNKNOWN = 3, 24, 35, 44
NORMALISER_MAP, NORMALISER_PREFIX, NORMALISER_SQUEEZE, NORMALISER_ESCAPE = 2, 3, 4, 5
KIND_NORMAL, KIND_UNKNOWN, KIND_CONTROL, KIND_BYTE = 1, 2, 3, 6
MODEL_BPE = 2

_SIDE = 21  # bits of a symbol in a pair's key
_NEVER = np.iinfo(np.int64).max


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a serialised message: integers, or the raw bytes of the rest."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(wire)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class PieceBpe:
    """Encoder and decoder for a BPE model file whose normaliser only marks spaces."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            fields = list(message_fields(f.read()))
        trainer = dict(message_fields(b"".join(v for k, v in fields if k == FIELD_TRAINER)))
        normaliser = dict(message_fields(b"".join(v for k, v in fields if k == FIELD_NORMALISER)))
        if trainer.get(TRAINER_KIND, 1) != MODEL_BPE or not trainer.get(TRAINER_BYTES, 0):
            raise ValueError("the model must be of the kind BPE with byte fallback")
        if (trainer.get(TRAINER_SUFFIX_MARK, 0) or normaliser.get(NORMALISER_MAP) or normaliser.get(NORMALISER_SQUEEZE, 1)
                or not normaliser.get(NORMALISER_ESCAPE, 1)):
            raise ValueError("the model's normaliser must leave texts as they are, but for marked spaces")
        self.prefix = bool(normaliser.get(NORMALISER_PREFIX, 1))
        self.unknown = trainer.get(TRAINER_UNKNOWN, b" \xe2\x81\x87 ").decode("utf-8")
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.byte_of: dict[int, int] = {}
        for raw in (v for k, v in fields if k == FIELD_PIECE):
            p = dict(message_fields(raw))
            i, text, kind = len(self.pieces), p[PIECE_TEXT].decode("utf-8"), p.get(PIECE_KIND, KIND_NORMAL)
            self.pieces.append(text)
            self.kinds.append(kind)
            if kind == KIND_NORMAL:
                self.ids[text] = i
                self.scores[text] = struct.unpack("<f", p[PIECE_SCORE])[0] if PIECE_SCORE in p else 0.0
            elif kind == KIND_BYTE:
                b = int(text[3:-1], 16)
                self.byte_ids[b], self.byte_of[i] = i, b
            elif kind not in (KIND_UNKNOWN, KIND_CONTROL):
                raise ValueError("pieces defined by a user, or unused, are not supported")
        crossing = any(MARK in t.lstrip(MARK) for t in self.ids)
        self.chunks = re.compile(r"(?s).+" if crossing else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.table: dict[str, bytes] = {}
        self.shown: dict[str, str] = {}
        self.first_normal = 1 + max((i for i, k in enumerate(self.kinds) if k != KIND_NORMAL), default=-1)
        # a symbol is the id of a piece, or for a character that is none, the number of pieces plus its code point
        size = len(self.pieces)
        self.symbol = np.arange(0x110000, dtype=np.int64) + size
        for t, i in self.ids.items():
            if len(t) == 1:
                self.symbol[ord(t)] = i
        splits = [(self.ids[t[:i]] << _SIDE | self.ids[t[i:]], j) for t, j in self.ids.items() for i in range(1, len(t))
                  if t[:i] in self.ids and t[i:] in self.ids]
        turns = {s: r for r, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        splits.sort()
        # a last key that no pair has, so that a search always ends inside
        self.pair_keys = np.array([*(k for k, _ in splits), 1 << 62], np.int64)
        self.pair_ids = np.array([*(j for _, j in splits), 0], np.int64)
        self.pair_turns = np.array([*(turns[self.scores[self.pieces[j]]] for _, j in splits), 0], np.int64)

    def segment_all(self, chunks: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """``segment`` of many chunks at once, as ids and the end of each chunk's.

        A round merges the best pair of every chunk that has one.
        """
        flat = np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4")
        size = np.array([len(c) for c in chunks], np.int64)
        symbol, chunk = self.symbol[flat], np.repeat(np.arange(len(chunks)), size)
        pair = np.full(len(symbol), -1)

        def look_up(at: np.ndarray) -> None:
            """Set ``pair`` at places from the symbols there and after them."""
            at = at[at >= 0]
            end = at + 1 >= len(symbol)
            right = np.where(end, 0, at + 1)
            found = np.searchsorted(self.pair_keys, key := symbol[at] << _SIDE | symbol[right])
            pair[at] = np.where((self.pair_keys[found] == key) & (chunk[right] == chunk[at]) & ~end, found, -1)

        look_up(np.arange(len(symbol)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            order = np.where(pair >= 0, self.pair_turns[pair] << 32 | np.arange(len(symbol)), _NEVER)
            first = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
            best = np.minimum.reduceat(order, first)
            more = best < _NEVER
            keep = np.repeat(more, np.diff(np.append(first, len(symbol))))
            done.append((chunk[~keep], symbol[~keep]))
            at = best[more] & 0xFFFFFFFF
            symbol[at] = self.pair_ids[pair[at]]
            keep[at + 1] = False
            at = np.cumsum(keep)[at] - 1
            symbol, chunk, pair = symbol[keep], chunk[keep], pair[keep]
            look_up(at)
            look_up(at - 1)
        chunk, symbol = (np.concatenate(x) for x in zip(*done)) if done else (chunk, symbol)
        turn = np.argsort(chunk, kind="stable")
        symbol, chunk = symbol[turn], chunk[turn]
        unknown = np.flatnonzero(symbol >= len(self.pieces))
        if len(unknown):  # a character that is no piece becomes the ids of its bytes
            spelled = [chr(c).encode("utf-8") for c in (symbol[unknown] - len(self.pieces)).tolist()]
            width = np.ones(len(symbol), np.int64)
            width[unknown] = [len(b) for b in spelled]
            is_byte = np.repeat(symbol >= len(self.pieces), width)
            symbol, chunk = np.repeat(symbol, width), np.repeat(chunk, width)
            symbol[is_byte] = np.array(self.byte_ids)[np.frombuffer(b"".join(spelled), np.uint8)]
        return symbol, np.cumsum(np.bincount(chunk, minlength=len(chunks)))

    def segment(self, chunk: str) -> list[int]:
        """Ids of a chunk: the adjacent pair of the best score is merged first, of equal ones the leftmost."""
        ids, scores = self.ids, self.scores
        n = len(chunk)
        part: list[str] = list(chunk)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(-scores[t], i, t) for i in range(n - 1) if (t := chunk[i : i + 2]) in scores]
        heapq.heapify(heap)
        while heap:
            _, i, text = heapq.heappop(heap)
            j = after[i]
            # a side that has been merged meanwhile no longer makes up the text
            if j >= n or not part[i] or part[i] + part[j] != text:
                continue
            part[i], part[j] = text, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (t := text + part[k]) in scores:
                    heapq.heappush(heap, (-scores[t], i, t))
            if (h := before[i]) >= 0 and (t := part[h] + text) in scores:
                heapq.heappush(heap, (-scores[t], h, t))
        out: list[int] = []
        for p in filter(None, part):
            if p in ids:
                out.append(ids[p])
            else:
                out += [self.byte_ids[b] for b in p.encode("utf-8")]
        return out

    def spell(self, ids: Sequence[int]) -> str:
        """The marked text that ids stand for; every byte that is no part of a character becomes U+FFFD."""
        if len(ids) and min(ids) >= self.first_normal:
            return "".join(map(self.pieces.__getitem__, ids))
        out: list[str] = []
        held = bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(_characters(bytes(held)))
                held.clear()
            if i is not None:
                kind = self.kinds[i]
                out.append(self.pieces[i] if kind == KIND_NORMAL else self.unknown if kind == KIND_UNKNOWN else "")
        return "".join(out)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: marks become spaces, but for the one before the text."""
        text = self.spell(ids)
        first = next((i for i in ids if self.kinds[i] != KIND_CONTROL), None)
        if self.prefix and first is not None and self.kinds[first] == KIND_NORMAL and text.startswith(MARK):
            text = text[1:]
        return text.replace(MARK, " ")

    def learn(self, chunks: set[str]) -> Mapping[str, bytes]:
        """The table, with the new ones of ``chunks`` segmented; long chunks stand in a table of this call.

        A chunk that its ids do not spell is noted in ``shown``, with what they spell.
        """
        if len(self.table) > TABLE_CHUNKS:
            self.table, self.shown = {}, {}
        new = chunks.difference(self.table)
        short = [c for c in new if len(c) <= KEPT_CHARS]
        flat, ends = self.segment_all(short)
        packed, places = flat.astype("<i4").tobytes(), (4 * ends).tolist()
        self.table.update((c, packed[lo:hi]) for c, lo, hi in zip(short, [0, *places], places))
        long = {c: self.segment(c) for c in new if len(c) > KEPT_CHARS}
        if self.spell(flat.tolist()) != "".join(short) or any(self.spell(ids) != c for c, ids in long.items()):
            for c in new:
                text = self.spell(long[c] if c in long else np.frombuffer(self.table[c], "<i4").tolist())
                if text != c:
                    self.shown[c] = text
        return ChainMap({c: array("i", ids).tobytes() for c, ids in long.items()}, self.table) if long else self.table

    def encode(self, texts: Sequence[str]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids as little-endian 32-bit integers, and the text they decode to."""
        lead = MARK if self.prefix else ""
        cut = [self.chunks.findall(lead + t.replace(" ", MARK)) if t else [] for t in texts]
        ids_of = self.learn(set().union(*cut)).__getitem__
        for chunks in cut:
            shown = "".join([self.shown.get(c, c) for c in chunks] if self.shown else chunks).replace(MARK, " ")
            yield b"".join(map(ids_of, chunks)), shown[1:] if self.prefix else shown


def _characters(raw: bytes) -> str:
    """UTF-8 with U+FFFD for every single byte that is no part of a character."""
    out: list[str] = []
    while raw:
        try:
            return "".join([*out, raw.decode("utf-8")])
        except UnicodeDecodeError as e:
            out += [raw[: e.start].decode("utf-8"), "�"]
            raw = raw[e.start + 1 :]
    return "".join(out)


_MODELS: dict[str, PieceBpe] = {}


def model(path: str) -> PieceBpe:
    if path not in _MODELS:
        _MODELS[path] = PieceBpe(path)
    return _MODELS[path]


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded): ids of whole texts without begin or end, and the text they decode to.

    NULL and empty texts have no ids and decode to the empty text.  Equal texts
    get equal ids; ids of rows may be NULL, repeat and be of any type.
    ``path`` names the model file, which every node has.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = model(path)
        for pdf in batches:
            bodies = list(pdf["body"])
            for lo, hi in byte_batches(bodies, BATCH):
                got = list(bpe.encode([(b or b"").decode("utf-8", "replace") for b in bodies[lo:hi]]))
                yield pd.DataFrame({"id": pdf["id"].iloc[lo:hi].array, "ids": [np.frombuffer(a, "<i4") for a, _ in got],
                                    "decoded": [d for _, d in got]})

    found = (df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("body"))
             .mapInPandas(run, "id string, ids array<int>, decoded string"))
    return found.select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), "ids", "decoded")
