import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabkiln.operators import joins, project, triples
from tabkiln.sources import read_csv, read_text_documents, write_csv, write_reports


def test_csv_roundtrip_nan_to_null(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "id long, v double")
    write_csv(df, str(tmp_path / "c"))
    back = read_csv(spark, str(tmp_path / "c"), schema="id long, v double")
    got = {r.id: r.v for r in back.collect()}
    assert got == {1: None, 2: 1.5}


def test_text_documents_whole_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("line one\nline two\n")
    (tmp_path / "b.txt").write_text("other")
    docs = read_text_documents(spark, str(tmp_path))
    texts = sorted(r.text for r in docs.collect())
    assert texts == ["line one\nline two\n", "other"]


def test_reports_partitioned_by_level_and_kind(spark, tmp_path):
    rep = spark.createDataFrame([(1, "main", 0.5), (1, "sub", 0.25), (2, "main", 1.0)], "level int, kind string, v double")
    write_reports(rep, str(tmp_path / "r"))
    assert sorted(os.listdir(tmp_path / "r" / "level=1")) == ["kind=main", "kind=sub"]
    assert spark.read.parquet(str(tmp_path / "r")).count() == 3


def test_attach_per_group_is_a_left_join(spark):
    big = spark.range(100).withColumn("g", F.col("id") % 10)
    small = spark.range(10).select(F.col("id").alias("g"), (F.col("id") * 2).alias("t"))
    got = joins.attach_per_group(big, small.filter("g < 9"), ["g"]).collect()
    assert len(got) == 100 and {(r.g, r.t) for r in got} == {(g, 2 * g if g < 9 else None) for g in range(10)}


def test_map_values_large_mapping_uses_join(spark):
    df = spark.range(3000).select(F.col("id").cast("int").alias("k"))
    mapping = {i: f"v{i}" for i in range(0, 3000, 2)}
    out = {r.k: r.k_name for r in project.map_values(df, "k", mapping, out="k_name").collect()}
    assert out[2] == "v2" and out[3] is None and len(out) == 3000


def test_formula_string_and_callable_keep_zero_and_null(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (None,)], "x double")
    out = [r.x for r in project.apply_formula(df, {"x": "x * x + 1"}).collect()]
    assert out == [0.0, 5.0, None]


def test_downcast_keeps_wide_longs(spark):
    df = spark.createDataFrame([(1, 2**40, 1.5), (None, None, None)], "a long, b long, c double")
    out = project.downcast_types(df)
    assert (out.first().a, out.first().b) == (1, 2**40)
    assert dict(out.dtypes) == {"a": "int", "b": "bigint", "c": "float"}
    assert dict(project.downcast_types(df.limit(0)).dtypes)["b"] == "int"


def test_pluggable_extractor(spark):
    chunks = spark.createDataFrame([(1, "Paris is in France")], "chunk_id long, text string")

    def extractor(batches):
        for pdf in batches:
            words = pdf["text"].str.split()
            yield pd.DataFrame(
                {"chunk_id": pdf["chunk_id"], "head": words.str[0], "relation": "in", "tail": words.str[-1]}
            )

    got = triples.extract_with(chunks, extractor).collect()
    assert [(r.head, r.tail) for r in got] == [("Paris", "France")]


def test_pair_features_guard(spark):
    df = spark.range(1).select(*[F.lit(1.0).alias(f"c{i}") for i in range(5)])
    from tabkiln.operators import scale

    with pytest.raises(ValueError):
        scale.pair_features(df, df.columns, max_cols=3)


def test_nan_is_missing_in_profiles_and_fills(spark):
    from tabkiln.operators import profile

    df = spark.createDataFrame([(1, float("nan")), (2, 1.0), (3, None), (4, 3.0)], "id long, v double")
    prof = {r["column"]: r["null_frac"] for r in profile.null_profile(df, 0.4).collect()}
    assert prof["v"] == 0.5
    stats = profile.column_stats(df, ["v"]).first()
    assert (stats["mean"], stats["min"], stats["max"]) == (2.0, 1.0, 3.0)
    roles = profile.distinct_profile(df, None, 10).collect()
    assert {r["column"]: r["n_distinct"] for r in roles}["v"] == 2
    filled = [r.v for r in project.fill_nulls(df, ["v"], 0.0).orderBy("id").collect()]
    assert filled == [0.0, 1.0, 0.0, 3.0]
    allnan = spark.createDataFrame([(1, float("nan"))], "id long, w double")
    assert project.drop_all_null_columns(allnan).columns == ["id"]
