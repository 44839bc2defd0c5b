"""Routing of equal windows to one task without shipping every window.

A window is ``window`` consecutive symbols (bytes or words) of one text.  Its
anchor is the leftmost ``gram``-symbol run with the least hash inside it, so
equal windows have equal anchors.  The windows of one text that share an
anchor position form a chunk: one row that carries ``window - 1`` symbols
more than it has windows.  Only anchors that occur twice keep their chunks;
equal chunks become one with a weight; the distinct chunks of an anchor meet
in one task, where a matcher finds the windows that occur again.  An anchor
with more than ``group_limit`` distinct chunks is cut into pieces: a grid laid
out from the anchor gives every window its piece, whatever else the chunk
holds, and the symbols that all windows of a piece share are its key.  Equal
pieces become one again.  A key that still has more than ``group_limit``
distinct pieces (the edge of a passage that many texts share) is cut into its
windows, and equal windows become one: no group grows with the corpus.

Results depend on content alone; nothing is capped or sampled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.common import BYTE_CODE, byte_batches, gram_hash, materialize, prefix_hash, release, row_id, word_hashes

#: A chunk's place in its text: first window, anchor's distance from it and number of windows in one long.
SHIFT, HALF = 32, 65536

#: (bodies, weights) -> for each body the (first, end) ranges of window starts that occur again
Matcher = Callable[[list[bytes], list[int]], list[list[tuple[int, int]]]]


@dataclass(frozen=True)
class Plan:
    """How texts are cut: ``words`` or bytes, window and gram length in symbols."""

    words: bool
    window: int
    gram: int  # less than HALF symbols below the window
    group_limit: int = 8192
    piece: int = 16
    task_bytes: int = 300_000

    def __post_init__(self) -> None:
        if not 0 < self.window - self.gram + 1 < HALF:
            raise ValueError(f"the window must be 0 to {HALF - 2} symbols longer than the gram")

    def symbols(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.words:
            return word_hashes(bodies)
        raw = np.frombuffer(b"".join(bodies), np.uint8)
        return BYTE_CODE[raw], np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype(np.int64)

    def cut(self, body: bytes) -> list[bytes] | bytes:
        return body.split() if self.words else body

    def join(self, part: list[bytes] | bytes) -> bytes:
        return b" ".join(part) if self.words else part


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def chunk_arrays(plan: Plan, bodies: list[bytes]) -> dict[str, np.ndarray]:
    """Chunks of a batch of texts: text index, anchor hash, content hash, first window, anchor's distance, number of windows."""
    codes, off = plan.symbols(bodies)
    none = {k: np.zeros(0, np.int64) for k in ("text", "gram", "chunk", "first", "off", "n")}
    if len(codes) < plan.window:
        return none
    prefix = prefix_hash(codes)
    h = gram_hash(prefix, plan.gram)
    ranked = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    anchor = (_sliding_min(ranked, plan.window - plan.gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    end = np.repeat(off[1:], np.diff(off))[: len(anchor)]
    at = np.flatnonzero(np.arange(len(anchor)) + plan.window <= end)
    if not len(at):
        return none
    a = anchor[at]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1)]))
    first, n = at[new], np.diff(np.concatenate([new, [len(at)]]))
    text = np.searchsorted(off, first, side="right") - 1
    return {"text": text, "gram": h[a[new]].view(np.int64),
            "chunk": _slice_hashes(plan, bodies, codes, first, first + n - 1 + plan.window),
            "first": first - off[text], "off": a[new] - first, "n": n}


def _slice_hashes(plan: Plan, bodies: list[bytes], codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of what the symbols of each slice hold: their bytes, or the hashes of their words."""
    width = codes.itemsize if plan.words else 1
    raw = memoryview(codes.tobytes() if plan.words else b"".join(bodies))
    return np.array([_bytes_hash(raw[width * a : width * b]) for a, b in zip(start.tolist(), end.tolist())], np.int64)


def _emit_chunks(plan: Plan):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bodies = [b or b"" for b in pdf["body"]]
            r1, r2 = pdf["r1"].to_numpy(), pdf["r2"].to_numpy()
            for lo, hi in byte_batches(bodies):
                c = chunk_arrays(plan, bodies[lo:hi])
                if len(c["text"]):
                    yield pd.DataFrame({"r1": r1[lo:hi][c["text"]], "r2": r2[lo:hi][c["text"]], "gram": c["gram"],
                                        "chunk": c["chunk"], "span": (c["first"] << SHIFT) + c["off"] * HALF + c["n"]})
        release()
    return run


def _bytes_hash(body: bytes) -> int:
    return xxhash.xxh3_64_intdigest(body) - 2**63


def _emit_bodies(plan: Plan):
    """Bodies of the wanted chunks of each text; those of crowded anchors in pieces."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out, size = [], 0
            for body, want in zip(pdf["body"], pdf["want"]):
                symbols = plan.cut(body)
                for w in want:
                    first, off, n = w["span"] >> SHIFT, w["span"] // HALF % HALF, w["span"] % HALF
                    if w["nd"] <= plan.group_limit:
                        out.append((w["gram"], w["chunk"], 0, w["gram"], w["chunk"], w["n"],
                                    plan.join(symbols[first : first + n - 1 + plan.window])))
                        size += len(out[-1][-1])
                        continue
                    for cell in range(-off // plan.piece, (n - 1 - off) // plan.piece + 1):
                        left = off + cell * plan.piece  # the cell's first window, counted from the chunk's; may lie before it
                        lo, hi = max(left, 0), min(left + plan.piece, n)
                        part = plan.join(symbols[first + lo : first + hi - 1 + plan.window])
                        core = plan.join(symbols[first + left + plan.piece - 1 : first + left + plan.window])
                        out.append((w["gram"], w["chunk"], lo, _bytes_hash(core + b"\0%d" % cell), _bytes_hash(part), w["n"], part))
                        size += len(part)
                if size > 4_000_000:
                    yield pd.DataFrame(out, columns=_BODY_COLS)
                    out, size = [], 0
            if out:
                yield pd.DataFrame(out, columns=_BODY_COLS)
        release()
    return run


def _emit_windows(plan: Plan):
    """Pieces window by window."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, mark, weight, part in zip(pdf["key"].tolist(), pdf["mark"].tolist(), pdf["weight"].tolist(), pdf["part"]):
                symbols = plan.cut(part)
                for i in range(len(symbols) - plan.window + 1):
                    body = plan.join(symbols[i : i + plan.window])
                    out.append((key, mark, i, _bytes_hash(body), weight, body))
                if len(out) > 10_000:
                    yield pd.DataFrame(out, columns=_WINDOW_COLS)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=_WINDOW_COLS)
    return run


_BODY_COLS = ["gram", "chunk", "lo", "key", "mark", "weight", "part"]
_BODY_SCHEMA = "gram long, chunk long, lo int, key long, mark long, weight long, part binary"
_WINDOW_COLS = ["key", "mark", "at", "w", "weight", "part"]
_WINDOW_SCHEMA = "key long, mark long, at int, w long, weight long, part binary"


def _match(plan: Plan, matcher: Matcher):
    """Feed whole groups of a key to the matcher, as many at a time as ``task_bytes`` hold."""
    def done(held: dict[tuple[int, int], tuple[bytes, int]]) -> pd.DataFrame:
        found = matcher([b for b, _ in held.values()], [n for _, n in held.values()])
        rows = [(k, m, s, e) for (k, m), ranges in zip(held, found) for s, e in ranges]
        return pd.DataFrame(rows, columns=["key", "mark", "s", "e"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], tuple[bytes, int]] = {}
        last, size = None, 0
        for pdf in batches:
            for key, mark, weight, part in zip(pdf["key"].tolist(), pdf["mark"].tolist(), pdf["weight"].tolist(), pdf["part"]):
                if size >= plan.task_bytes and key != last:
                    yield done(held)
                    held, size = {}, 0
                last = key
                if (key, mark) not in held:
                    held[key, mark] = (part, weight)
                    size += len(part)
        if held:
            yield done(held)
        release()
    return run


def repeated_windows(df: DataFrame, id_col: str, text_col: str, plan: Plan, matcher: Matcher) -> DataFrame:
    """(r1, r2, ranges): for each text, by its row id, the ranges [s, e) of symbols that repeated windows cover.

    Texts without a repeated window have no row.  NULL and empty texts have no windows.
    """
    rows = df.select(*row_id(id_col, text_col), F.col(text_col).cast("binary").alias("body")).filter("body IS NOT NULL")
    occ = materialize(rows.mapInPandas(_emit_chunks(plan), "r1 long, r2 long, gram long, chunk long, span long"), "chunks")
    # written, so that the join below deals both sides by plain exchanges and AQE can split a hot anchor's rows
    twice = materialize(occ.groupBy("gram").agg(F.count("*").alias("c")).filter("c > 1").select("gram"), "grams")
    occ = materialize(occ.join(twice, "gram", "left_semi"), "chunks2")
    groups = occ.groupBy("gram", "chunk").agg(F.count("*").alias("n"), F.min(F.struct("r1", "r2", "span")).alias("at"))
    crowd = groups.groupBy("gram").agg(F.count("*").alias("nd"))
    want = (groups.join(crowd, "gram").groupBy("at.r1", "at.r2")
            .agg(F.collect_list(F.struct("gram", "chunk", "n", "nd", "at.span")).alias("want")))
    bodies = materialize(want.join(rows, ["r1", "r2"]).select("want", "body").mapInPandas(_emit_bodies(plan), _BODY_SCHEMA), "bodies")
    plain = bodies.filter("gram = key AND chunk = mark")
    cut = bodies.filter("NOT (gram = key AND chunk = mark)")
    once = [F.sum("weight").alias("weight"), F.first("part").alias("part")]
    merged = materialize(cut.groupBy("key", "mark").agg(*once), "pieces")
    crowded = merged.groupBy("key").agg(F.count("*").alias("nd")).filter(F.col("nd") > plan.group_limit).select("key")
    windows = materialize(merged.join(crowded, "key", "left_semi").select("key", "mark", "weight", "part")
                          .mapInPandas(_emit_windows(plan), _WINDOW_SCHEMA), "windows")
    single = windows.groupBy("w").agg(*once).select(F.col("w").alias("key"), F.col("w").alias("mark"), "weight", "part")
    hits = (plain.select("key", "mark", "weight", "part").unionByName(merged.join(crowded, "key", "left_anti")).unionByName(single)
            .repartition("key").sortWithinPartitions("key", "mark")
            .mapInPandas(_match(plan, matcher), "key long, mark long, s int, e int"))
    hits = materialize(hits, "hits")
    pieces = (cut.select("gram", "chunk", "lo", "key", "mark").distinct()
              .join(windows.select("key", "mark", "at", "w"), ["key", "mark"], "left")
              .select("gram", "chunk", (F.col("lo") + F.coalesce("at", F.lit(0))).alias("lo"),
                      F.coalesce("w", "key").alias("key"), F.coalesce("w", "mark").alias("mark")))
    found = hits.join(pieces, ["key", "mark"], "left").select(
        F.coalesce("gram", "key").alias("gram"), F.coalesce("chunk", "mark").alias("chunk"),
        (F.col("s") + F.coalesce("lo", F.lit(0))).alias("s"), (F.col("e") + F.coalesce("lo", F.lit(0))).alias("e"))
    first = F.shiftright("span", SHIFT)
    return (occ.join(found, ["gram", "chunk"])
            .groupBy("r1", "r2")
            .agg(F.array_sort(F.collect_set(F.struct((first + F.col("s")).alias("s"), (first + F.col("e") - 1 + plan.window).alias("e")))).alias("ranges")))


def merge_ranges(ranges) -> list[tuple[int, int]]:
    """Union of sorted ranges; touching ranges become one."""
    out: list[tuple[int, int]] = []
    for r in ranges if ranges is not None else []:
        s, e = int(r["s"]), int(r["e"])
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def drop_ranges(symbols, ranges: list[tuple[int, int]]) -> list:
    """The slices of ``symbols`` outside the ranges."""
    kept, at = [], 0
    for s, e in ranges:
        kept.append(symbols[at:s])
        at = e
    kept.append(symbols[at:])
    return kept
