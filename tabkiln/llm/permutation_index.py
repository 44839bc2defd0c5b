"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order of nearness.  A slab
posts its vectors in one inverted file per pivot, with the pivot's place in
the vector's order.  A query reads the files of its own nearest pivots, adds
up what each posting takes off the footrule distance, and reranks the part of
the slab with the least distance by the exact inner product.

Inner products become angles by one more dimension that brings every vector
to the largest norm of the table (queries get 0 there).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.tiles import finite_vectors, tile_topk

PIVOTS = 512
PREFIX = 64
RERANK = 0.12
PIVOT_SAMPLE = 4_096


def _augment(v: np.ndarray, norm: float) -> np.ndarray:
    """Vectors of norm 1 whose angles to queries order them by inner product."""
    rest = np.sqrt(np.maximum(norm * norm - (v * v).sum(axis=1), 0))
    return np.concatenate([v, rest[:, None]], axis=1) / norm


def nearest_pivots(v: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """For each row its ``prefix`` nearest pivots, nearest first (ties to the first pivot)."""
    near = np.round(v @ pivots.T, 12)
    part = np.argpartition(-near, prefix - 1, axis=1)[:, :prefix] if prefix < near.shape[1] else np.tile(np.arange(near.shape[1]), (len(v), 1))
    turn = np.lexsort((part, -np.take_along_axis(near, part, axis=1)), axis=1)
    return np.take_along_axis(part, turn, axis=1)


class InvertedFiles:
    """Postings (row, place) of a slab, by pivot."""

    def __init__(self, prefixes: np.ndarray, pivots: int) -> None:
        n, self.prefix = prefixes.shape
        flat = prefixes.ravel()
        turn = np.argsort(flat, kind="stable")
        self.rows, self.places, self.n = turn // self.prefix, turn % self.prefix, n
        self.bounds = np.searchsorted(flat[turn], np.arange(pivots + 1))

    def gains(self, query: np.ndarray) -> np.ndarray:
        """What common pivots take off the footrule distance, for each row (a missing pivot counts as place ``prefix``)."""
        out = np.zeros(self.n, np.int64)
        for place, pivot in enumerate(query):
            lo, hi = self.bounds[pivot], self.bounds[pivot + 1]
            out[self.rows[lo:hi]] += 2 * (self.prefix - np.maximum(self.places[lo:hi], place))
        return out


def inner_products(v: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Double-precision sums, dimension by dimension, so equal rows get equal scores."""
    out = np.zeros(len(v))
    for column, x in zip(v.T, query):
        out += column * x
    return out


def choose_pivots(vectors: DataFrame, pivots: int, sample: int) -> dict[int, np.ndarray]:
    """Distinct vectors from the ``sample`` rows with the least id hash, by number of dimensions."""
    rows = vectors.orderBy(F.xxhash64(F.lit(3), F.col("id")), "id").limit(sample).select("vec").collect()
    out: dict[int, list] = {}
    for v in dict.fromkeys(tuple(r["vec"]) for r in rows):
        group = out.setdefault(len(v), [])
        if len(group) < pivots:
            group.append(v)
    return {d: np.array(group) for d, group in out.items()}


def search(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20,
           pivots: int = PIVOTS, prefix: int = PREFIX, rerank: float = RERANK, sample: int = PIVOT_SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): about the ``k`` largest inner products for each query.

    Queries are the rows whose id is divisible by ``every``; a query's own id is
    no candidate.  Every row is indexed; pivots come from a sample of at most
    ``sample`` rows.  Scores are exact.  Rows without id, vectors that are NULL,
    empty, zero or hold NULL or non-finite components take no part.
    """
    vectors = finite_vectors(df, id_col, vector_col).filter(F.exists("vec", lambda x: x != 0))
    queries = vectors.filter(F.col("id") % every == 0)
    chosen = choose_pivots(vectors, pivots, sample)
    largest = vectors.select(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x).alias("n")).agg(F.max("n")).first()[0] or 1.0

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        q, v, ids = np.stack(left["vec"].to_numpy()), np.stack(right["vec"].to_numpy()), right["id"].to_numpy()
        norm = float(np.sqrt(largest))
        centre = chosen.get(v.shape[1], v[:pivots])
        centre = _augment(centre, norm)
        length = min(prefix, len(centre))
        files = InvertedFiles(nearest_pivots(_augment(v, norm), centre, length), len(centre))
        unit = np.concatenate([q / np.sqrt((q * q).sum(axis=1))[:, None], np.zeros((len(q), 1))], axis=1)
        take = max(4 * k, int(np.ceil(rerank * len(v))))
        out = []
        for qid, query, order in zip(left["id"].to_numpy(), q, nearest_pivots(unit, centre, length)):
            gain = files.gains(order)
            if take < len(v):
                edge = np.partition(gain, len(v) - take)[len(v) - take]
                rows = np.concatenate([np.flatnonzero(gain > edge), np.flatnonzero(gain == edge)])[:take]
            else:
                rows = np.arange(len(v))
            rows = rows[ids[rows] != qid]
            score = inner_products(v[rows], query)
            turn = np.lexsort((ids[rows], -score))[:k]
            out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[rows[turn]], "score": score[turn]}))
        return pd.concat(out)

    return tile_topk(vectors, queries, k, "double", best)
