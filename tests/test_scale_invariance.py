"""The same answer at every size, width and layout: NULL and NaN keys, repeated keys, many ranges, other core counts."""

import math

import pytest
from pyspark.sql import functions as F

from tabkiln.operators import encode, flows, hierarchy, impute, joins, metrics, models, ordered, profile, project, reduce, segments, split


def _keyed(spark, n=400):
    key = F.when(F.col("id") % 10 == 0, None).otherwise((F.col("id") * 7919) % 1009).cast("double")
    key = F.when(F.col("id") % 50 == 3, F.lit(float("nan"))).otherwise(key)
    return spark.range(n).select("id", key.alias("k"), F.when(F.col("id") % 4 == 0, F.col("id")).cast("double").alias("v"))


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 25])
def test_row_index_keeps_rows_without_a_key(spark, rows_per_bucket):
    df = _keyed(spark)
    got = ordered.add_row_index(df, ["k", "id"], rows_per_bucket=rows_per_bucket).collect()
    kf = lambda r: (0, 0.0, r.id) if r.k is None else (2, 0.0, r.id) if math.isnan(r.k) else (1, r.k, r.id)
    want = {r.id: i for i, r in enumerate(sorted(df.collect(), key=kf), 1)}
    assert {r.id: r.row_index for r in got} == want


def test_fill_is_the_same_with_one_and_many_ranges(spark):
    df = _keyed(spark).withColumn("v", F.when(F.col("id") % 8 == 1, F.lit(float("nan"))).otherwise(F.col("v")))
    one, many = (
        {r.id: r.v for r in ordered.fill_forward_backward(df, ["k", "id"], ["v"], rows_per_bucket=n).collect()}
        for n in (1_000_000, 25)
    )
    assert len(one) == 400 and one == many and all(v is not None and not math.isnan(v) for v in one.values())


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 25])
def test_rank_cuts_among_rows_without_a_key(spark, rows_per_bucket):
    df = _keyed(spark).filter("k IS NULL OR NOT isnan(k)")
    cuts, n = ordered.rank_cuts(df, ["k", "id"], [5, 200], rows_per_bucket)
    for rank in (5, 200):
        assert df.filter(ordered.at_or_before(df, ["k", "id"], cuts[rank])).count() == rank


def test_string_keys_are_ordered(spark):
    df = spark.range(300).select(F.md5(F.col("id").cast("string")).alias("k"))
    got = {r.k: r.row_index for r in ordered.add_row_index(df, "k", rows_per_bucket=20).collect()}
    assert got == {k: i for i, k in enumerate(sorted(got), 1)}


@pytest.mark.parametrize("hot", [1, 3])
def test_holdout_sizes_are_exact_with_repeated_keys(spark, hot, monkeypatch):
    for rows in (1_000_000, 50):
        monkeypatch.setattr(ordered.rank_cuts, "__defaults__", (rows, None))
        df = spark.range(500).select(F.when(F.col("id") % 3 < hot, 7).otherwise(F.col("id")).alias("key"), F.col("id").alias("x"))
        got = split.holdout_split(df, "key", 0.2).groupBy("split").count().collect()
        assert {r["split"]: r["count"] for r in got} == {"test": 100, "train": 400}


def test_pca_keeps_rows_with_missing_columns(spark):
    df = spark.createDataFrame([(i, float(i % 7), None if i % 4 == 0 else float(i)) for i in range(40)], "id int, a double, b double")
    out, _ = reduce.pca_features(df, ["a", "b"], 2, keep=["id"])
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 40 and all((rows[i].pca_0 is None) == (i % 4 == 0) for i in range(40))


def test_one_hot_joins_values_that_share_a_name(spark):
    df = spark.createDataFrame([("EN",), ("en",), ("de",), (None,)], "lang string")
    got = [tuple(r) for r in encode.fit_onehot(df, ["lang"]).transform(df).select("lang_en", "lang_de").collect()]
    assert got == [(1, 0), (1, 0), (0, 1), (0, 0)]
    clash = spark.createDataFrame([("b_c", "c")], "a string, a_b string")
    with pytest.raises(ValueError):
        encode.fit_onehot(clash, ["a", "a_b"]).transform(clash)


def test_tiny_variance_correlates_at_every_width(spark):
    cols = [F.rand(i).alias(f"c{i}") for i in range(15)]
    df = spark.range(200).select((F.col("id") * 1e-8).alias("t"), *cols, F.lit(0.1).alias("const"))
    for names in (["t", "c0", "c1"], ["t", *[f"c{i}" for i in range(15)], "const"]):
        a = {(r.col_a, r.col_b): r.corr for r in profile.correlation_pairs(df, names, "aggregate").collect()}
        b = {(r.col_a, r.col_b): r.corr for r in profile.correlation_pairs(df, names).collect()}
        assert a.keys() == b.keys()
        assert all((a[k] is None and b[k] is None) or a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_value_map_type_does_not_follow_its_length(spark):
    df = spark.range(10).select(F.col("id").cast("int").alias("k"))
    short, long = ({i: i * 2 for i in range(n)} for n in (5, 1500))
    a, b = project.map_values(df, "k", short, "v"), project.map_values(df, "k", long, "v")
    assert a.schema["v"].dataType == b.schema["v"].dataType
    assert {r.k: r.v for r in a.collect()} == {i: i * 2 if i < 5 else None for i in range(10)}


def test_segment_mean_takes_whole_vectors(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 2.0, 3.0]), (1, 1, [3.0, 2.0, 5.0])], "id int, seg_no int, logits array<double>")
    assert segments.aggregate_segments(df, "id").first().logits == [2.0, 2.0, 4.0]
    with pytest.raises(Exception, match="more than 2 logits"):
        segments.aggregate_segments(df, "id", n_logits=2).collect()


def test_rows_without_a_label_count_nowhere(spark):
    df = spark.createDataFrame([("a", 0.9, 1), ("a", 0.2, 0), ("a", 0.7, None), ("b", 0.1, None)], "c string, p double, y int")
    rows = metrics.overall_metrics(df, "p", "y", "c").collect()
    assert [r.tp + r.fp + r.tn + r.fn for r in rows] == [2, 2]
    assert [(r.c, r.num_samples) for r in metrics.category_report(df, "p", "y", "c").collect()] == [("a", 2)]


def test_imputation_fills_nan_and_says_when_it_cannot(spark):
    df = spark.range(200).select(
        "id",
        (F.col("id") % 5).cast("double").alias("x"),
        F.when(F.col("id") % 9 == 0, None).when(F.col("id") % 9 == 1, F.lit(float("nan"))).otherwise(F.col("id") % 5).cast("double").alias("n"),
        F.lit(None).cast("double").alias("other"),
    )
    out = impute.model_impute(df, ["n"], "id", learner="dt", features=["x"]).collect()
    assert len(out) == 200 and all(r.n == pytest.approx(r.x) for r in out)
    with pytest.raises(ValueError):
        impute.model_impute(df, ["n"], "id", learner="dt", features=["other"])


def test_training_layout_follows_the_rows_alone(spark):
    df = spark.range(1000).select("id", F.rand(1).alias("x"))
    tag = lambda d: {r.id: r.p for r in models.spread(d, "id").withColumn("p", F.spark_partition_id()).collect()}
    assert tag(df.repartition(2)) == tag(df.repartition(13))


def test_learners_take_strings_and_many_valued_integers(spark):
    df = spark.range(600).select(
        "id",
        F.concat(F.lit("s"), F.col("id") % 3).alias("s"),
        (F.col("id") % 40).cast("int").alias("k"),
        (F.col("id") % 7).cast("double").alias("f"),
    )
    df = df.withColumn("y", (F.col("id") % 3) * 10.0 + F.col("k") * 0.1)
    res = models.cv_regression(df, df, "id", "y", learner="rf", cat_threshold=50, params={"numTrees": 10})
    assert set(res.features) == {"s", "k", "f"} and models.categorical_features(df, ["s", "k", "f"], 50) == ["s", "k"]
    imp = {r.feature: r.importance for r in res.importance.collect()}
    assert max(imp, key=imp.get) == "s" and res.predictions.count() == 600
    plan = res.predictions._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_loss_is_pluggable(spark):
    df = spark.createDataFrame([(1, "main", 0, "a", 2.0, 1.0)], "level int, kind string, label_idx int, label_name string, logit double, y double")
    row = hierarchy.hierarchical_bce(df, loss=lambda p, t: F.abs(F.col(p) - F.col(t))).first()
    assert row.loss == pytest.approx(1.0)


def test_filled_integers_that_do_not_fit_stay_long(spark):
    df = spark.createDataFrame([(1, 5_000_000_000, 1.0), (2, None, float("nan")), (3, 7, 4e9)], "id long, a long, b double")
    out = project.downcast_types(df, ["a", "b"]).orderBy("id")
    assert [(r.a, r.b) for r in out.collect()] == [(5_000_000_000, 1), (0, 0), (7, 4_000_000_000)]


def test_one_hot_raises_above_its_bound(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    assert len(encode.fit_onehot(df, ["a", "b"], max_values=30).values["a"]) == 30
    with pytest.raises(ValueError):
        encode.fit_onehot(df, ["a", "b"], max_values=29)


def test_first_row_of_each_key_and_names(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, None)], "k int, seq int, v string")
    assert sorted(map(tuple, joins.first_per_key(df, "k", "seq", ["v"]).collect())) == [(1, "a"), (2, None)]
    assert project.normalize_names(df.toDF(" K", "Seq ", "v")).columns == ["k", "seq", "v"]


def test_cleaning_survives_saving(spark, tmp_path):
    df = spark.range(100).select(
        "id",
        F.when(F.col("id") % 5 != 0, F.col("id") * 2.0).alias("a"),
        (F.col("id") * 4.0).alias("twin"),
        F.when(F.col("id") % 5 == 0, 1.0).alias("rare"),
        (F.col("id") % 9).cast("double").alias("w"),
        F.col("id").cast("double").alias("y"),
    )
    fit = flows.fit_cleaning(df, "id", "y", collinear_threshold=0.8)
    fit.save(spark, str(tmp_path / "c"))
    back = flows.load_cleaning(spark, str(tmp_path / "c"))
    assert fit.rejected == ["rare"] and fit.collinear == ["twin"] and back.features == ["a", "w"]
    rows = back.transform(df.drop("y")).orderBy("id").collect()
    assert rows == fit.transform(df.drop("y")).orderBy("id").collect() and len(rows) == 100
    assert min(r.a for r in rows) == 0.0 and max(r.a for r in rows) == 10.0


def test_roles_are_exact_near_the_threshold(spark):
    df = spark.range(20_000).select(
        "id",
        *[(F.col("id") % n).alias(f"c{n}") for n in (2, 99, 100, 101, 5000)],
        F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(1.0).alias("f"),
        F.lit(None).cast("string").alias("none"),
    )
    roles = profile.column_roles(df, "c2", 100)
    assert roles.categorical == ("c99", "none")
    assert {c: roles.distinct[c] for c in ("c99", "c100", "c101", "f", "none")} == {"c99": 99, "c100": 100, "c101": 101, "f": 1, "none": 0}
    assert profile.column_roles(df, "c2", 100, exclude_float=False).categorical == ("c99", "f", "none")
