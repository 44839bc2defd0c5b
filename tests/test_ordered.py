"""The range-split ordered helpers equal a plain global window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabkiln.operators import ordered, split
from tabkiln.plans import fixtures as fx

from conftest import SF


def test_row_index_many_ranges_equals_window(spark):
    e = fx.t(spark, SF, "events").select("event_id")
    got = ordered.add_row_index(e, "event_id", "ix", start=1, rows_per_bucket=700)
    ref = e.withColumn("ix_ref", F.row_number().over(Window.orderBy("event_id")))
    bad = got.join(ref, "event_id").filter(F.col("ix") != F.col("ix_ref")).count()
    assert bad == 0
    assert got.count() == e.count()


def test_fill_many_ranges_equals_window(spark):
    o = fx.ordered(spark, SF)
    got = ordered.fill_forward_backward(o, "event_id", ["v"], rows_per_bucket=333)
    w = Window.orderBy("event_id")
    ref = o.withColumn(
        "v_ref",
        F.coalesce(
            F.col("v"),
            F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
            F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)),
        ),
    )
    joined = got.select("event_id", "v").join(ref.select("event_id", "v_ref"), "event_id")
    assert joined.filter(~F.col("v").eqNullSafe(F.col("v_ref"))).count() == 0
    assert joined.filter(F.col("v").isNull()).count() == 0


def test_leading_nulls_take_backward_value(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 5.0), (4, None), (5, 7.0)], "k long, v double")
    got = {r.k: r.v for r in ordered.fill_forward_backward(df, "k", ["v"], rows_per_bucket=2).collect()}
    assert got == {1: 5.0, 2: 5.0, 3: 5.0, 4: 5.0, 5: 7.0}


def test_folds_match_ntile_sizes(spark):
    for n, k in [(11, 3), (10, 5), (7, 2), (100, 3)]:
        df = spark.range(n).withColumnRenamed("id", "k")
        got = ordered.assign_folds(df, "k", k, rows_per_bucket=3)
        ref = df.withColumn("f_ref", F.ntile(k).over(Window.orderBy("k")) - 1)
        assert got.join(ref, "k").filter(F.col("fold") != F.col("f_ref")).count() == 0


def test_holdout_exact_size_and_disjoint(spark):
    o = fx.t(spark, SF, "orders").select("o_orderkey")
    tagged = split.holdout_split(o, "o_orderkey", 0.2, seed=7)
    counts = {r["split"]: r["count"] for r in tagged.groupBy("split").count().collect()}
    n = o.count()
    import math

    assert counts["test"] == math.ceil(n * 0.2)
    assert counts["test"] + counts["train"] == n


def test_group_split_keeps_groups_whole(spark):
    df = spark.range(200).select((F.col("id") % 37).alias("g"), F.col("id"))
    tagged = split.split_by_group(df, "g", 0.25)
    sides = tagged.groupBy("g").agg(F.countDistinct("split").alias("s"))
    assert sides.filter("s > 1").count() == 0


def test_rank_cuts_many_ranges(spark):
    from tabkiln.operators.split import rank_cuts

    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    cuts, n = rank_cuts(df, ["k"], [1, 250, 999, 1000, 1001], rows_per_bucket=90)
    assert n == 1000
    assert cuts[1] == (0,) and cuts[250] == (249,) and cuts[1000] == (999,) and cuts[1001] is None


def test_three_way_sizes(spark):
    import math

    o = fx.t(spark, SF, "orders").select("o_orderkey")
    n = o.count()
    counts = {r["split"]: r["count"] for r in split.three_way_split(o, "o_orderkey").groupBy("split").count().collect()}
    held = math.ceil(n * 0.4)
    assert counts["test"] == math.ceil(held * 0.5)
    assert counts["val"] == held - counts["test"]
    assert counts["train"] == n - held


def test_hot_leading_key_is_split_and_order_kept(spark):
    # a third of the rows share one leading-key value; the second key orders them
    rows = [(0 if i % 3 == 0 else i, i) for i in range(900)]
    df = spark.createDataFrame(rows, "k1 long, k2 long")
    ranged, n = ordered.with_ranges(df, ["k1", "k2"], rows_per_bucket=60)
    sizes = [r["count"] for r in ranged.groupBy("_range_id").count().collect()]
    assert n == 900 and max(sizes) < 150  # the 300 hot rows are spread over several ranges
    got = ordered.add_row_index(df, ["k1", "k2"], "ix", rows_per_bucket=60)
    ref = df.withColumn("ix_ref", F.row_number().over(Window.orderBy("k1", "k2")))
    assert got.join(ref, ["k1", "k2"]).filter(F.col("ix") != F.col("ix_ref")).count() == 0
    filled = ordered.fill_forward_backward(
        df.withColumn("v", F.when(F.col("k2") % 7 == 0, F.col("k2").cast("double"))), ["k1", "k2"], ["v"], rows_per_bucket=60
    )
    w = Window.orderBy("k1", "k2")
    src = df.withColumn("v", F.when(F.col("k2") % 7 == 0, F.col("k2").cast("double")))
    ref2 = src.withColumn(
        "v_ref",
        F.coalesce("v", F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing))),
    )
    bad = filled.select("k1", "k2", "v").join(ref2.select("k1", "k2", "v_ref"), ["k1", "k2"]).filter(~F.col("v").eqNullSafe(F.col("v_ref")))
    assert bad.count() == 0


def test_hot_single_key_ties_spread(spark):
    # rows tied on the key differ in another column (fully identical rows cannot be told apart)
    df = spark.createDataFrame([(0 if i % 2 == 0 else i, f"p{i}") for i in range(800)], "k long, payload string")
    ranged, _ = ordered.with_ranges(df, ["k"], rows_per_bucket=50)
    sizes = [r["count"] for r in ranged.groupBy("_range_id").count().collect()]
    assert max(sizes) < 200
    got = ordered.add_row_index(df, "k", "ix", rows_per_bucket=50)
    assert sorted(r["ix"] for r in got.collect()) == list(range(1, 801))


def test_string_keys_with_a_common_prefix_are_ordered(spark):
    df = spark.range(3000).select(F.format_string("customer-0%07d", F.pmod(F.col("id") * 7919, F.lit(3000))).alias("k"),
                                  F.when(F.col("id") % 5 == 0, F.col("id")).alias("v"), F.col("id"))
    ref = df.withColumn("ix_ref", F.row_number().over(Window.orderBy("k")))
    for order in ("k", ["k", "id"]):
        got = ordered.add_row_index(df, order, "ix", rows_per_bucket=100)
        assert got.join(ref, "id").filter("ix = ix_ref").count() == 3000
        assert ordered.rank_cuts(df, [order] if order == "k" else order, [1000], rows_per_bucket=100)[0][1000][0] == "customer-00000999"
    ranged, _ = ordered.with_ranges(df, "k", 100)
    assert ranged.groupBy("_range_id").count().agg(F.max("count")).first()[0] < 300
    hot = df.withColumn("k", F.when(F.col("id") % 3 == 0, "customer-00001500").otherwise(F.col("k")))
    got = ordered.add_row_index(hot, ["k", "id"], "ix", rows_per_bucket=100)
    ref = hot.withColumn("ix_ref", F.row_number().over(Window.orderBy("k", "id")))
    assert got.join(ref, "id").filter("ix = ix_ref").count() == 3000
    index = {r["ix"]: r["k"] for r in ordered.add_row_index(hot, "k", "ix", rows_per_bucket=100).collect()}
    assert list(map(index.get, range(1, 3001))) == sorted(index.values())


def _wide(spark, n=2000):
    """Keys that a double cannot tell apart, as decimals, longs, dates, booleans, bytes and arrays."""
    i = F.pmod(F.col("id") * 7919, F.lit(n))
    return spark.range(n).select(
        "id", i.alias("i"),
        (F.lit("100000000000000000000000000000").cast("decimal(38,0)") + i).cast("decimal(38,0)").alias("dec"),
        (F.lit(2**62) + F.floor(i / 500)).alias("big"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.floor(i / 700).cast("int")).alias("day"),
        (i % 2 == 0).alias("flag"), F.encode(F.format_string("%06d", i), "utf-8").alias("raw"), F.array(F.lit(1), i).alias("arr"),
        F.when(i % 6 == 0, i.cast("double")).alias("v"))


@pytest.mark.parametrize("order", [["dec"], ["big", "i"], ["day", "flag", "i"], ["raw"], ["arr"], ["flag", "dec"]])
def test_every_orderable_key_equals_a_window(spark, order):
    df = _wide(spark)
    w = Window.orderBy(*order)
    ref = df.select("id", F.row_number().over(w).alias("ref"), F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("last"),
                    F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("next"))
    got = ordered.add_row_index(df, order, "ix", rows_per_bucket=90).join(ref, "id")
    assert got.filter("ix = ref").count() == 2000
    filled = ordered.fill_forward_backward(df, order, ["v"], rows_per_bucket=90).join(ref, "id")
    assert filled.filter(F.col("v") == F.coalesce("last", "next")).count() == 2000


@pytest.mark.parametrize("order", [["dec"], ["big", "i"], ["day", "flag", "i"], ["raw"]])
def test_folds_of_every_literal_key(spark, order, monkeypatch):
    monkeypatch.setattr(ordered, "SAMPLE_KEYS", 40)
    df = _wide(spark)
    got = ordered.assign_folds(df, order, 7, rows_per_bucket=50)
    ref = df.select("id", (F.ntile(7).over(Window.orderBy(*order)) - 1).alias("ref"))
    assert got.join(ref, "id").filter("fold = ref").count() == 2000


def test_ranks_beside_a_key_that_most_rows_share(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SAMPLE_KEYS", 10)
    keys = [5] * 3000 + [1, 2, 3, 4, 6, 7, 8] + [None] * 40
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    want = sorted(keys, key=lambda k: -1 if k is None else k)
    ranks = [1, 40, 41, 44, 45, 3044, 3045, 3047]
    cuts, n = ordered.rank_cuts(df, ["k"], [0, *ranks, 3048], rows_per_bucket=20)
    assert n == len(keys) and cuts == {0: None, 3048: None} | {r: (want[r - 1],) for r in ranks}


def test_ranges_keep_maps_and_columns_without_a_type(spark):
    df = spark.range(300).select("id", F.create_map(F.lit("k"), "id").alias("m"), F.lit(None).alias("none"))
    got = ordered.add_row_index(df, "id", "ix", rows_per_bucket=40)
    assert got.columns == ["id", "m", "none", "ix"] and got.filter("ix = id + 1 AND m['k'] = id AND none IS NULL").count() == 300


def test_holdout_split_hashes_every_row_once(spark):
    df = spark.range(1000).selectExpr("id", "sha1(cast(id as string)) AS x")
    tagged = split.holdout_split(df, "id", 0.2)
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "sha1" not in plan
    assert tagged.columns == ["id", "x", "split"]
    assert tagged.filter("split = 'test'").count() == 200 and tagged.drop("split").exceptAll(df).isEmpty()
