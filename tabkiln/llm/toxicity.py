"""Toxicity by a subsequence string kernel and a support vector machine.

The kernel of two words adds up, over all common subsequences of three
characters, a weight that falls with the span each covers (gaps are allowed up
to ``SPAN`` characters), and is normalised to 1 for equal words; a word with
characters slipped in keeps most of its kernel value.  Its ``POWER``-th power,
a kernel too, tells such words from those that share a syllable.  Landmarks are words of
labelled training texts.  A text's kernel with a landmark is its best word's,
and the Nyström map turns these values into the features of a linear support
vector machine with squared hinge loss, whose margins a logistic fit turns
into scores.

Only the fit is bounded: it reads at most ``max_rows`` labelled texts (those
with the least id hash).  Scoring reads every word of every text.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from string import punctuation

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.common import byte_batches, fresh_names, materialize, release

SPAN = 7
DECAY = 0.7
LANDMARKS = 160
MAX_ROWS = 20_000
FLOOR = 0.4
POWER = 4
PIECE = 32
CACHE_WORDS = 500_000
REJECT = 0.3
GROUP = 6
ROUNDING = 1e-4
ROWS = 2_000
SAMPLED, TRUST = 16, 16.0
START = "\x02"
_DROP = re.compile(r"[^\w\s]+|_+")
_SPACED = re.compile(r"(?<!\S)(?:\S\s){2,}\S(?!\S)")
_OFFSETS = [(a, b) for a in range(1, SPAN - 1) for b in range(a + 1, SPAN)]


def pieces(word: str) -> list[str]:
    """A word behind a mark for its start, so that a word's head counts as such, in overlapping pieces of ``PIECE`` characters."""
    word = START + word
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - PIECE // 2, PIECE // 2)]


def tokens(text: str) -> list[str]:
    """Lower-case letters and digits between white space; a run of single characters also counts as one token."""
    text = _DROP.sub("", text.lower())
    return text.split() + ["".join(m.split()) for m in _SPACED.findall(text)]


def token_set(text: str) -> set[str]:
    """The distinct ``tokens`` of a text; only distinct words are looked at unless single characters follow each other."""
    raw = text.lower().split()
    found = set(raw)
    clean = {}
    for w in [w for w in found if not w.isalnum()]:
        inner = w.strip(punctuation)
        clean[w] = inner if inner.isalnum() else _DROP.sub("", inner)
    found.difference_update(clean)
    single = {w for w in found if len(w) == 1}.union([w for w, c in clean.items() if len(c) == 1])
    if single and b"\1\1\1" in bytes(map(single.__contains__, raw)):
        return set(tokens(text))
    found.update(clean.values())
    found.discard("")
    return found


def triples(words: list[str], code: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Subsequences of three characters: their word, first two letters, third letter and weight; and the number of letters.

    ``code`` numbers the characters that take part (-1: not); without it all do.
    """
    text = "\0".join(words)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    word = np.cumsum(points == 0)
    if code is None:
        alphabet, letter = np.unique(points, return_inverse=True)
        known, base = points != 0, len(alphabet)
    else:
        letter = code[points]
        known, base = letter >= 0, int(code.max()) + 1
    out_w, out_p, out_t, out_v = [], [], [], []
    for a, b in _OFFSETS:
        n = len(points) - b
        if n <= 0:
            continue
        ok = np.flatnonzero((word[:n] == word[b:]) & known[:n] & known[a : a + n] & known[b:])
        out_w.append(word[ok])
        out_p.append(letter[ok] * base + letter[ok + a])
        out_t.append(letter[ok + b])
        out_v.append(np.full(len(ok), DECAY ** (b + 1)))
    if not out_w:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0), base
    return np.concatenate(out_w), np.concatenate(out_p), np.concatenate(out_t), np.concatenate(out_v), base


def _summed(word: np.ndarray, pair: np.ndarray, third: np.ndarray, value: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per word and subsequence."""
    key = pair * base + third
    cells = int(base) ** 3 * (int(word.max()) + 1 if len(word) else 0)
    turn = np.argsort(word * base**3 + key) if cells < 2**62 else np.lexsort((key, word))
    word, key, value = word[turn], key[turn], value[turn]
    first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (key[1:] != key[:-1])])) if len(word) else np.zeros(0, np.int64)
    return word[first], key[first], np.add.reduceat(value, first) if len(first) else value


def self_kernels(words: list[str]) -> np.ndarray:
    w, _, v = _summed(*triples(words, None))
    return np.bincount(w, v * v, minlength=len(words)) if len(words) else np.zeros(0)


#: Least possible kernel of a word with itself, by its length (a piece, or one with a character slipped in): all its
#: subsequences differ.
_LEAST = np.array([sum(max(n - b, 0) * DECAY ** (2 * (b + 1)) for _, b in _OFFSETS) for n in range(PIECE + 2)])


@dataclass
class Kernel:
    """Similarities of words to landmarks."""

    landmarks: list[str]
    code: np.ndarray = field(init=False)  # by code point

    def __post_init__(self) -> None:
        letters = sorted(set("".join(self.landmarks)))
        base = len(letters)  # also the number of all other characters
        code = np.full(sys.maxunicode + 1, -1, np.int32)
        code[[ord(c) for c in letters]] = np.arange(base)
        self.own = np.sqrt(self_kernels(self.landmarks))
        mark, key, value = _summed(*triples(self.landmarks, code))
        self.code = np.where(code < 0, np.int32(base), code)
        keys, key = np.unique(key, return_inverse=True)
        # first two letters, then the third: the table grows with the pairs that landmarks have, not with letters cubed
        heads, head = np.unique(keys // base, return_inverse=True)
        self.base = base + 1
        self.rows = np.full(self.base**2, len(heads) * self.base)  # the last row is that of unknown pairs
        self.rows[heads // base * self.base + heads % base] = np.arange(len(heads)) * self.base
        self.place = np.full((len(heads) + 1) * self.base, len(keys))
        self.place[head * self.base + keys % base] = np.arange(len(keys))
        # landmarks much alike share a group, whose greatest value of a subsequence bounds that of each
        value = value / self.own[mark]
        self.members = self._groups(mark, key, value)
        self.groups = len(self.members)
        group, slot = np.zeros(len(self.landmarks), np.int64), np.zeros(len(self.landmarks), np.int64)
        for g, some in enumerate(self.members):
            group[some[some >= 0]], slot[some[some >= 0]] = g, np.flatnonzero(some >= 0)
        cells, cell = np.unique(key * self.groups + group[mark], return_inverse=True)
        self.values = np.zeros((len(cells) + 1, GROUP))  # the last row is that of subsequences which no member has
        self.values[cell, slot[mark]] = value
        self.cell = np.full((len(keys) + 1) * self.groups, len(cells), np.int32)
        self.cell[cells] = np.arange(len(cells))
        self.most = self.values.max(axis=1).astype(np.float32)[self.cell].reshape(-1, self.groups)

    def _groups(self, mark: np.ndarray, key: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The landmarks in groups of ``GROUP`` (-1: none), each of one and those left that are most like it."""
        m = len(self.landmarks)
        alike = np.zeros((m, m))
        turn = np.argsort(key, kind="stable")
        for some in np.split(turn, np.flatnonzero(np.diff(key[turn])) + 1):
            alike[np.ix_(mark[some], mark[some])] += value[some][:, None] * value[some]
        out, left = np.full((-(-m // GROUP), GROUP), -1), np.arange(m)
        for row in out:
            like = alike[np.ix_(left, left)]
            first = np.argmax(like.sum(axis=1))
            like[first, first] = np.inf
            turn = np.argsort(-like[first], kind="stable")
            row[: len(left)] = left[turn[:GROUP]]
            left = np.sort(left[turn[GROUP:]])
        return out

    def near(self, words: list[str], floor: float = FLOOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of a word, landmark it resembles by at least ``floor``, and how much: all such pairs, in order.

        Words of one length are taken together.  A group's bound leaves out the landmarks that a word cannot be near to.
        """
        size = np.fromiter(map(len, words), np.int64, len(words))
        letter = self.code[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        start = np.cumsum(size) - size
        out_w, out_l, out_r = [], [], []
        for n in np.unique(size[size > 2]).tolist():
            w = np.flatnonzero(size == n)
            letters = np.ascontiguousarray(letter[start[w] + np.arange(n)[:, None]])
            heads = {a: self.rows[letters[: n - a] * self.base + letters[a:]] for a in range(1, min(SPAN - 1, n))}
            at, weight, bound = [], [], np.zeros((len(w), self.groups), np.float32)
            some, part = np.empty_like(bound), np.empty_like(bound)
            for b in range(2, min(SPAN, n)):
                part[:] = 0
                for a in range(1, b):
                    found = self.place[heads[a][: n - b] + letters[b:]]
                    for row in found:
                        part += self.most.take(row, axis=0, out=some, mode="clip")
                    at.append(found)
                    weight += [DECAY ** (b + 1)] * len(found)
                bound += part * np.float32(DECAY ** (b + 1))
            least = floor * np.sqrt(_LEAST[n])
            at, weight = np.concatenate(at), np.array(weight)
            which, group = np.nonzero(bound >= np.float32(least * (1 - ROUNDING)))
            step = max(100_000 // len(weight), 1)
            for lo in range(0, len(which), step):
                i, g = which[lo : lo + step], group[lo : lo + step]
                cell = self.cell.take(at.take(i, axis=1) * self.groups + g)
                raw = (weight @ self.values.take(cell, axis=0).reshape(len(weight), -1)).reshape(-1, GROUP)
                pair, slot = np.nonzero((raw > 0) & (raw >= least))
                out_w.append(w[i[pair]])
                out_l.append(self.members[g[pair], slot])
                out_r.append(raw[pair, slot])
        if not out_w:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        w, l, raw = np.concatenate(out_w), np.concatenate(out_l), np.concatenate(out_r)
        turn = np.lexsort((l, w))
        w, l, raw = w[turn], l[turn], raw[turn]
        which, back = np.unique(w, return_inverse=True)
        sim = raw / np.sqrt(self_kernels([words[i] for i in which]))[back]
        near = sim >= floor
        return w[near], l[near], sim[near]

    def similarities(self, words: list[str], floor: float = FLOOR) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each word the landmarks it resembles by at least ``floor``, and how much."""
        w, l, sim = self.near(words, floor)
        cut = np.searchsorted(w, np.arange(len(words) + 1))
        return [(l[i:j], sim[i:j]) for i, j in zip(cut[:-1], cut[1:])]


class TextFeatures:
    """Kernel values of texts with the landmarks; remembers words seen by this worker."""

    def __init__(self, kernel: Kernel) -> None:
        self.kernel, self.plain, self.hits = kernel, set(), {}

    def learn(self, words: set[str]) -> None:
        if len(self.plain) > CACHE_WORDS:
            self.plain, self.hits = set(), {}
        new = words - self.plain
        new.difference_update(self.hits)
        self.plain.update(new)
        parts, owner = [], []
        for t in new:
            if 2 < len(t) < PIECE:
                parts.append(START + t)
                owner.append(t)
            elif len(t) >= PIECE:
                some = pieces(t)
                parts += some
                owner += [t] * len(some)
        for lo in range(0, len(parts), 4_000):
            for i, l, s in zip(*(x.tolist() for x in self.kernel.near(parts[lo : lo + 4_000]))):
                best = self.hits.setdefault(owner[lo + i], {})
                best[l] = max(best.get(l, 0.0), s)
        self.plain.difference_update(new & self.hits.keys())

    def rows(self, bodies: list[bytes]) -> np.ndarray:
        sets = [token_set(b.decode("utf-8", "replace")) for b in bodies]
        self.learn(set().union(*sets))
        out = np.zeros((len(bodies), len(self.kernel.landmarks)))
        for row, words in zip(out, sets):
            best = {}
            for t in words & self.hits.keys():
                for l, s in self.hits[t].items():
                    if s > best.get(l, 0.0):
                        best[l] = s
            row[list(best)] = list(best.values())
        return out**POWER


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray  # on kernel values: Nyström map and support vector weights in one
    bias: float
    slope: float
    shift: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        margin = features @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps (y is -1 or 1).

    Each step adds up ``ROWS`` rows at a time, so that ``x`` is never copied whole.
    """
    d = x.shape[1] + 1
    ridge = np.eye(d)
    ridge[-1, -1] = 1e-6
    w = np.zeros(d)
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * len(y) * cost
    for _ in range(rounds):
        grad, curve = ridge @ w, ridge.copy()
        for lo in range(0, len(x), ROWS):
            some = slice(lo, lo + ROWS)
            a = np.concatenate([x[some], np.ones((len(x[some]), 1))], axis=1)
            slack = np.maximum(1 - y[some] * (a @ w), 0)
            on = slack > 0
            a, weight = a[on], share[some][on]
            grad -= 2 * a.T @ (weight * y[some][on] * slack[on])
            curve += 2 * a.T @ (a * weight[:, None])
        step = np.linalg.solve(curve, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def logistic(margin: np.ndarray, label: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and shift of the scores: a logistic fit of the labels to the margins.

    The targets are smoothed by half a row of either class: one clean text alone is expected at 0.25, below ``REJECT``.
    """
    up, down = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (up + 0.5) / (up + 1), 0.5 / (down + 1))
    a = np.stack([margin, np.ones(len(margin))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2), a.T @ (p - target) + 1e-6 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int) -> DataFrame:
    """(id, body, label) of at most ``max_rows`` labelled texts outside the held-out part."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .filter("id IS NOT NULL AND label IN (0, 1) AND crc32(cast(cast(id as string) as binary)) % 4 <> 2")
             .groupBy("id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    # at most max_rows ids: small by its parameter
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("body")).filter("body IS NOT NULL")
    return materialize(texts.join(F.broadcast(known), "id").dropDuplicates(["body", "label"]), "labelled")


def choose_landmarks(rows: DataFrame, count: int, sampled: int = SAMPLED) -> dict[str, float]:
    """The words that tell toxic from other training texts best and ``sampled`` words more of either class, with their trust.

    The gain is the exponent of Chernoff's bound for a word's share of toxic texts under the share of all texts.  No
    gain is too small, but the trust, gain / (gain + ``TRUST``), scales the word's feature, so that the support vector
    machine's ridge weighs most on words whose share may have come up by chance.
    """
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(w, y) for b, y in zip(pdf["body"], pdf["label"].tolist())
                   for w in {p for t in token_set(b.decode("utf-8", "replace")) if len(t) > 2 for p in pieces(t)}]
            yield pd.DataFrame(out, columns=["word", "label"])
        release()

    toxic, n = rows.agg(F.sum("label"), F.count("*")).first()
    if not toxic or toxic == n:
        return {}
    base = toxic / n
    seen, share = F.col("up") + F.col("down"), F.col("up") / (F.col("up") + F.col("down"))
    common = F.when(F.col("up") > 0, share * F.log(share / base)).otherwise(0.0)
    rare = F.when(F.col("down") > 0, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    found = materialize(rows.mapInPandas(words, "word string, label int").groupBy("word")
                        .agg(F.sum("label").alias("up"), F.sum(1 - F.col("label")).alias("down"))
                        .withColumn("gain", seen * (common + rare)).withColumn("toxic", share > base), "words")
    best = found.filter("toxic AND gain > 0").orderBy(F.col("gain").desc(), "word").limit(count)
    more = [found.filter(f"{c} > 0").orderBy(F.xxhash64("word"), "word").limit(sampled) for c in ("up", "down")]
    return {r["word"]: r["gain"] / (r["gain"] + TRUST) for part in (best, *more) for r in part.select("word", "gain").collect()}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        landmarks: int = LANDMARKS, max_rows: int = MAX_ROWS) -> Model:
    """Learn from labelled texts whose id's CRC-32 leaves another remainder than 2 modulo 4.

    With one class only (or no word in any labelled text), every text gets the share of toxic labels (0 without labels)
    as its score.
    """
    rows = training_rows(docs, labels, id_col, text_col, label_col, max_rows)
    trust = choose_landmarks(rows, landmarks)
    words = list(trust)
    if not words:
        up, n = rows.agg(F.sum("label"), F.count("*")).first()
        share = min(max((up or 0) / n if n else 0.0, 1e-9), 1 - 1e-9)
        return Model(["   "], np.zeros(1), 0.0, 0.0, math.log(share / (1 - share)))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = TextFeatures(Kernel(words))
        for pdf in batches:
            x = make.rows(list(pdf["body"]))
            at = [np.flatnonzero(row) for row in x]
            yield pd.DataFrame({"id": pdf["id"].astype("string"), "label": pdf["label"], "at": [i.astype("<i4").tobytes() for i in at],
                                "x": [row[i].astype("<f8").tobytes() for row, i in zip(x, at)]})
        release()

    # few of a text's values are not 0: the driver is sent these alone, and they stay packed until they have their place
    sample = rows.mapInPandas(features, "id string, label int, at binary, x binary").collect()
    sample.sort(key=lambda r: r["id"])
    label = np.array([r["label"] for r in sample])
    x = np.zeros((len(sample) + int(label.sum()), len(words)))
    for row, r in zip(x, sample):
        row[np.frombuffer(r["at"], "<i4")] = np.frombuffer(r["x"], "<f8")
    n = len(sample)
    del sample
    kernel = Kernel(words)
    among = np.zeros((len(words), len(words)))
    for row, (marks, sim) in zip(among, kernel.similarities(words, 0.0)):
        row[marks] = sim**POWER
    value, vector = np.linalg.eigh((among + among.T) / 2)
    nystrom = vector / np.sqrt(np.maximum(value, 1e-3)) @ vector.T * np.array(list(trust.values()))
    # inserted characters: each toxic text also enters with the kernel values its landmarks keep with a character slipped in
    gapped = np.array([_kept(kernel, w, i) for i, w in enumerate(words)])
    for row, i in zip(x[n:], np.flatnonzero(label == 1)):
        row[:] = x[i] * gapped
    label = np.concatenate([label, np.ones(len(x) - n, label.dtype)])
    for lo in range(0, len(x), ROWS):
        x[lo : lo + ROWS] = x[lo : lo + ROWS] @ nystrom
    w, bias = squared_hinge(x, np.where(label == 1, 1.0, -1.0))
    slope, shift = logistic(x @ w + bias, label)
    del x, kernel
    release()
    return Model(words, nystrom @ w, bias, slope, shift)


def _kept(kernel: Kernel, word: str, i: int) -> float:
    half = len(word) // 2
    marks, sim = kernel.similarities([word[:half] + "∧" + word[half:]], 0.0)[0]
    return float((sim[marks == i] ** POWER).sum())


def score_column(model: Model, text_col: str) -> Column:
    """Score of a text; NULL and empty texts are scored as texts without words."""
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        make = TextFeatures(Kernel(model.landmarks))
        for series in batches:
            bodies = [b or b"" for b in series]
            out = [model.scores(make.rows(bodies[lo:hi])) for lo, hi in byte_batches(bodies, 1_000_000)]
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))
        release()

    return run(F.col(text_col).cast("binary"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = REJECT) -> DataFrame:
    """(id, held_out, score, predicted) for every text."""
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2
    return (docs.select(F.col(id_col), held.alias("held_out"), score_column(model, text_col).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = REJECT) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores below ``threshold``."""
    name, = fresh_names(docs, "__score")
    return docs.withColumn(name, score_column(model, text_col)).filter(F.col(name) < threshold).drop(name)
