"""Mixing of sources to target weights by capped water-filling, in DataFrame expressions alone.

Every source asks for its weight's share of the total size; a source that
would be repeated more than ``max_epochs`` times is clamped there, and what it
leaves is shared again by weight until no source is above its cap.  A source
then takes its rows as often as the target holds them whole; of the rest it
takes the rows whose seeded hash lies below a cut, found by two histograms of
hash buckets, so the size taken is near the target and equal on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkiln.llm.common import fresh_names, materialize

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
_BUCKETS = 4096


def word_count(text_col: str) -> Column:
    """Words (runs outside 0x20 and 0x09-0x0D) of a text; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def seeded_bucket(id_col: str, text_col: str, seed: str) -> Column:
    """24 bits of a hash of the id and the text, so that rows without id, or with one id, are cut apart too."""
    name = F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("\n"), F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 6), 16, 10).cast("int")


def water_fill(sources: DataFrame, max_epochs: float) -> DataFrame:
    """``sources`` (weight, source_size) with their targets, which add up to the total size."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = float(total or 0) / weight if weight else 0.0
    while True:
        above = cap < F.col("weight") * level
        fixed, free = sources.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        raised = (total - (fixed or 0.0)) / free if free else level
        if not free or raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(cap, F.col("weight") * level))


def _rows(df: DataFrame, id_col: str, source_col: str, text_col: str, seed: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
                     seeded_bucket(id_col, text_col, seed).alias("u"))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def _cumulated(counts: DataFrame, by: str) -> DataFrame:
    """Running sizes inside each source; a source has at most ``_BUCKETS`` rows here."""
    return counts.withColumn("after", F.sum("n").over(Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)))


def plan_mix(rows: DataFrame, weights: tuple[float, ...], max_epochs: int) -> DataFrame:
    """(source, source_size, target, whole, cut): how often a source is taken whole, and the hash cut of its last part."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    sources = water_fill(materialize(sources.withColumn("weight", weight), "sources"), max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = materialize(sources.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    coarse = _cumulated(rows.groupBy("source", F.floor(F.col("u") / _BUCKETS).alias("b")).agg(F.sum("size").alias("n")), "b")
    edge = (coarse.alias("c").join(sources.alias("s"), _same("c", "s"))
            .filter((F.col("after") - F.col("n") <= F.col("rest")) & (F.col("after") > F.col("rest")))
            .select("s.source", "b", (F.col("after") - F.col("n")).alias("base"), "rest"))
    edge = materialize(edge, "edges")
    fine = (rows.alias("r").join(edge.alias("e"), _same("r", "e") & (F.floor(F.col("r.u") / _BUCKETS) == F.col("e.b")))
            .groupBy("r.source", "e.b", "e.base", "e.rest", "r.u").agg(F.sum("size").alias("n")))
    cut = (_cumulated(fine, "u").filter(F.col("base") + F.col("after") - F.col("n") / 2 <= F.col("rest"))
           .groupBy("source").agg((F.max("u") + 1).alias("cut")))
    plan = (sources.alias("s").join(edge.alias("e"), _same("s", "e"), "left").join(cut.alias("c"), _same("s", "c"), "left")
            .select("s.source", "source_size", "target", "whole", F.coalesce(F.col("cut"), F.col("b") * _BUCKETS, F.lit(0)).alias("cut")))
    return materialize(plan, "mix")


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "") -> DataFrame:
    """(id, source, size, source_size, target, copies) for every row of ``df``.

    Sources, ordered by code point with NULL last, get the ``weights`` in turn.
    ``copies`` is how often the mix takes the row, never more than
    ``max_epochs``.  Rows without words have size 0.  Rows that repeat id and
    text are taken equally often.  A source without words has target 0.
    """
    rows = materialize(_rows(df, id_col, source_col, text_col, seed), "sizes")
    plan = plan_mix(rows, weights, max_epochs)
    copies = F.col("whole") + F.when(F.col("u") < F.col("cut"), 1).otherwise(0)
    return (rows.alias("r").join(plan.alias("p"), _same("r", "p"))
            .select(F.col("id").alias(id_col), F.col("r.source").alias(source_col), "size", "source_size", "target", F.least(copies, F.lit(max_epochs)).alias("copies")))


def mix_rows(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "") -> DataFrame:
    """The rows of ``df`` with all their columns, each as often as ``mix`` takes it."""
    plan = plan_mix(materialize(_rows(df, id_col, source_col, text_col, seed), "sizes"), weights, max_epochs)
    name, copy = fresh_names(df, "__plan", "__copy")
    plan = plan.select(F.struct(*plan.columns).alias(name))
    taken = F.col(f"{name}.whole") + F.when(seeded_bucket(id_col, text_col, seed) < F.col(f"{name}.cut"), 1).otherwise(0)
    return (df.join(plan, F.col(source_col).eqNullSafe(F.col(f"{name}.source")))
            .withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), F.least(taken, F.lit(max_epochs))))).filter(F.col(copy) > 0).select(df.columns))
