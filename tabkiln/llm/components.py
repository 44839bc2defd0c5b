"""Connected components by minimum labels with pointer jumping; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkiln.llm.common import materialize


def min_labels(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the smallest node it reaches."""
    both = materialize(edges.select("u", "v").union(edges.select("v", "u")).filter("u <> v").distinct(), "edges")
    labels = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("root")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("root").alias("m"))
                .withColumnRenamed("u", "node"))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("far"))
        labels = materialize(step.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("far", "root")).alias("root")), "labels")
        if labels.filter("old <> root").isEmpty():
            return labels.select("node", "root")
        labels = labels.select("node", "root")


def merge_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (sid, comp) after linking by ``edges`` (a, b) over sids."""
    linked = (edges.join(labels.select(F.col("sid").alias("a"), F.col("comp").alias("u")), "a")
              .join(labels.select(F.col("sid").alias("b"), F.col("comp").alias("v")), "b").select("u", "v"))
    roots = min_labels(linked)
    return materialize(labels.join(roots.withColumnRenamed("node", "comp"), "comp", "left")
                       .select("sid", F.coalesce("root", "comp").alias("comp")), "components")
