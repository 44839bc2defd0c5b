"""Overlapping text windows and their aggregation back to documents.

Windowing is a projection plus ``posexplode``: each document is split into
whitespace tokens and cut into windows of ``length`` tokens whose starts are
``length - overlap`` apart, without Python.  Aggregating segment scores back
to documents is a partial aggregate keyed by the document id, so a document
with a huge number of segments is reduced map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.functions import sigmoid, tokens


def window_starts(n_tokens: Column, length: int, overlap: int) -> Column:
    """0-based window starts: one window when the text fits, otherwise a new
    window every ``length - overlap`` tokens until a window reaches the end."""
    step = length - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than length")
    last = F.greatest(n_tokens - F.lit(overlap) - 1, F.lit(0))
    return F.sequence(F.lit(0), last, F.lit(step))


def text_windows(
    df: DataFrame,
    key: str,
    text: str,
    length: int = 256,
    overlap: int = 64,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``(key, carry..., seg_no, tokens)``: one row per window of whole-text tokens."""
    toks = tokens(text)
    staged = df.select(key, *carry, toks.alias("_toks"))
    starts = window_starts(F.size("_toks"), length, overlap)
    windows = F.transform(starts, lambda s: F.slice(F.col("_toks"), s + 1, length))
    return staged.select(key, *carry, F.posexplode(windows).alias("seg_no", "tokens"))


def chunk_documents(df: DataFrame, key: str, text: str, size: int = 256, carry: Sequence[str] = ()) -> DataFrame:
    """Non-overlapping chunks of ``size`` tokens (K1): ``(key, carry..., chunk_no, chunk_text)``."""
    w = text_windows(df, key, text, size, 0, carry)
    return w.select(key, *carry, F.col("seg_no").alias("chunk_no"), F.array_join("tokens", " ").alias("chunk_text"))


def aggregate_segments(
    df: DataFrame,
    key: str,
    logits: str = "logits",
    strategy: str = "mean",
    n_logits: int | None = None,
    order: str = "seg_no",
    carry: Sequence[str] = (),
    positive: int = 1,
) -> DataFrame:
    """Segment logits to one vector per key.

    ``mean``: element-wise mean over the whole vectors; their length is read
    from the data, or stated by ``n_logits`` to spare that pass (a longer vector
    then raises).  ``max``: the whole vector of the segment with
    the largest logit at ``positive``, ties to the first segment.  ``carry``
    columns come from the first segment of each key.
    """
    if strategy not in ("mean", "max"):
        raise ValueError("strategy must be 'mean' or 'max'")
    if strategy == "mean":
        vec = F.col(logits)
        if n_logits is None:
            n_logits = df.agg(F.max(F.size(logits))).first()[0] or 0
        else:
            vec = F.when(F.size(logits) > n_logits, F.raise_error(F.lit(f"more than {n_logits} logits"))).otherwise(vec)
        agg = F.array(*[F.avg(F.get(vec, F.lit(i))) for i in range(n_logits)])
    else:
        agg = F.max_by(F.col(logits), F.struct(F.col(logits)[positive], -F.col(order)))
    meta = [F.min_by(F.col(c), F.col(order)).alias(c) for c in carry]
    return df.groupBy(key).agg(*meta, agg.alias(logits), F.count(F.lit(1)).alias("n_segments"))


def positive_probability(df: DataFrame, logits: str = "logits", positive: int = 1, out: str = "prob") -> DataFrame:
    """Sigmoid of the positive logit (the reference takes class 1 after a sigmoid, not a softmax)."""
    return df.withColumn(out, sigmoid(F.col(logits)[positive]))
