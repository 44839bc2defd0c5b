"""Query-by-candidate tiles: a stated query set meets all vectors in bounded blocks.

Vectors are dealt into slabs and queries into blocks by a hash of their id; a
tile holds one slab and one block, so its size never grows with the table.
Each tile returns its best rows per query; the tiles' bests are merged.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLAB = 16_384
BLOCK = 8_192


def finite_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec) of the rows that have an id and a non-empty vector of finite numbers."""
    ok = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
            .filter("id IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0").filter(ok))


def tile_topk(vectors: DataFrame, queries: DataFrame, k: int, score_type: str,
              best: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
              slab: int = SLAB, block: int = BLOCK) -> DataFrame:
    """The ``k`` best (query_id, rank, vec_id, score); ``best(queries, slab)`` ranks one tile.

    Vectors of different lengths never meet.  Ties go to the smaller vec_id.  A
    query row given several times is one query; an id with several vectors asks
    with each, and its answers are ranked together.
    """
    queries = queries.dropDuplicates(["id", "vec"])
    n, q = vectors.count(), queries.count()
    slabs, blocks = max(1, -(-n // slab)), max(1, -(-q // block))
    dim = F.size("vec").alias("dim")
    v = vectors.select("id", "vec", dim, F.pmod(F.xxhash64("id"), F.lit(slabs)).cast("int").alias("s"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    w = queries.select("id", "vec", dim, F.pmod(F.xxhash64(F.lit(1), F.col("id")), F.lit(blocks)).cast("int").alias("b"),
                       F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("s"))

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
        return best(left, right.sort_values("id", kind="stable"))

    keys = ["dim", "s", "b"]
    found = w.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInPandas(tile, f"query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
