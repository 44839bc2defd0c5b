"""Correlation paths agree: pairwise aggregates and the one-pass Gramian."""

from pyspark.sql import functions as F

from tabkiln.operators import profile

from conftest import SF


def test_gramian_matches_aggregates(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    cols = []
    exprs = []
    for k in range(10):
        name = f"f{k}"
        cols.append(name)
        exprs.append((F.col("l_extendedprice") * (k % 5 + 1) + F.col("l_quantity") * k + (F.col("l_orderkey") % (k + 2)) * 1000.0 + 1e6).alias(name))
    exprs.append(F.lit(3.0).alias("const"))
    exprs.append(F.when(F.col("l_linenumber") != 1, F.col("l_discount")).alias("holey"))
    for k in range(5):  # gaps of many patterns; h0 holds one value on two thirds of the rows
        gap = F.col("l_orderkey") % (k + 2) == 0
        exprs.append(F.when(~gap, F.when(F.col("l_orderkey") % 3 != 0, F.lit(7.5)).otherwise(F.col("l_quantity"))
                            if k == 0 else F.col("l_discount") * k + F.col("l_tax")).alias(f"h{k}"))
        cols.append(f"h{k}")
    exprs += [F.when(F.col("l_linenumber") > 2, float("nan")).otherwise(F.col("l_tax")).alias("nan"), F.lit(None).cast("double").alias("none")]
    df = li.select(*exprs)
    cols += ["const", "holey", "nan", "none"]
    a = {(r.col_a, r.col_b): r.corr for r in profile.correlation_pairs(df, cols, method="aggregate").collect()}
    g = {(r.col_a, r.col_b): r.corr for r in profile.correlation_pairs(df, cols, method="gramian").collect()}
    assert a.keys() == g.keys()
    for k in a:
        if a[k] is None:
            assert g[k] is None, k
        else:
            assert abs(a[k] - g[k]) < 1e-9, (k, a[k], g[k])


def test_gramian_takes_few_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.0, None)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.corr for r in profile.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert abs(got["a", "b"] - 1) < 1e-12 and got["a", "c"] is None and got["b", "c"] is None
    assert {r.corr for r in profile.correlation_pairs(df.limit(0), ["a", "b", "c"]).collect()} == {None}
