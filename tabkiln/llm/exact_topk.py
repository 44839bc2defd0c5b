"""Exact top-k inner products by columnar branch and bound.

A slab is laid out vertically, one row per dimension.  A query adds up its
partial scores block of dimensions by block; after each block the mass that
remains bounds what a candidate can still gain or lose (Cauchy-Schwarz on the
remaining dimensions), and candidates that cannot reach the k-th best lower
bound are compacted away.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.tiles import finite_vectors, tile_topk

DIMENSION_BLOCK = 8
_LONG = 2**63 - 1


def branch_and_bound(columns: np.ndarray, tails: np.ndarray, query: np.ndarray, k: int, block: int,
                     skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and exact scores that hold the ``k`` best of the vertical table ``columns`` (ties included)."""
    d = len(query)
    rows = np.arange(columns.shape[1]) if skip is None else np.flatnonzero(~skip)
    score = np.zeros(len(rows), columns.dtype)
    everything = skip is None or not skip.any()
    for i, lo in enumerate(range(0, d, block)):
        part = columns[lo : lo + block]
        part = part if everything and len(rows) == columns.shape[1] else part[:, rows]
        score = score + query[lo : lo + block] @ part
        if lo + block >= d or len(rows) <= k:
            continue
        rest = tails[i + 1][rows] * float(np.sqrt((query[lo + block :].astype(float) ** 2).sum()))
        rest = rest * (1 + 1e-9) + 1e-6
        value = score.astype(float)
        rest = rest + np.abs(value) * 1e-12
        floor = np.partition(value - rest, len(rows) - k)[len(rows) - k]
        keep = value + rest >= floor
        if not keep.all():
            rows, score = rows[keep], score[keep]
    return rows, score


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5,
          scale: int = 256, block: int = DIMENSION_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products for each query.

    Components become ``floor(scale * x)``.  Queries are the rows whose id is
    divisible by ``every``; a query's own id is no candidate.  Rows without id,
    vectors that are NULL, empty or hold NULL or non-finite components take no
    part.  Sums beyond 53 bits are added as integers of any length; a score
    outside the long range is reported as the end of that range.
    """
    vectors = finite_vectors(df, id_col, vector_col)
    queries = vectors.filter(F.col("id") % every == 0)

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        q, v = (np.floor(scale * np.stack(p["vec"].to_numpy())) for p in (left, right))
        ids = right["id"].to_numpy()
        most = float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1]
        if most >= 2.0**53:
            q, v = (np.array([[int(x) for x in r] for r in m], dtype=object) for m in (q, v))
        columns = np.ascontiguousarray(v.T)
        square = columns.astype(float) ** 2
        tails = [np.sqrt(square[lo:].sum(axis=0)) for lo in range(0, q.shape[1], block)]
        out = []
        for qid, query in zip(left["id"].to_numpy(), q):
            a, b = np.searchsorted(ids, [qid, qid + 1])
            skip = None
            if b > a:
                skip = np.zeros(len(ids), bool)
                skip[a:b] = True
            rows, score = branch_and_bound(columns, tails, query, k, block, skip)
            if score.dtype == object:
                turn = sorted(range(len(rows)), key=lambda i: (-score[i], ids[rows[i]]))
            else:
                turn = np.lexsort((ids[rows], -score))
            out += [(qid, ids[rows[i]], max(-_LONG - 1, min(_LONG, int(score[i])))) for i in turn[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return tile_topk(vectors, queries, k, "long", best)
