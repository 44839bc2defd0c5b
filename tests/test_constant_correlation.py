"""A constant column has no correlation, however its rows lie in partitions."""

from pyspark.sql import functions as F

from tabkiln.operators import profile


def test_constants_have_no_correlation_in_any_layout(spark):
    df = spark.range(0, 700, 1, 13).select(
        F.when(F.col("id") % 5 != 0, 3.1).alias("c"), F.lit(0.1).alias("t"), F.rand(3).alias("y"), F.rand(4).alias("z")
    )
    for parts in (1, 7, 13):
        got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation_pairs(df.coalesce(parts), ["c", "t", "y", "z"], "aggregate").collect()}
        assert [k for k, v in got.items() if v is not None] == [("y", "z")], parts
        target = {r["column"]: r["corr"] for r in profile.target_correlation(df.coalesce(parts), ["c", "t", "z"], "y").collect()}
        assert target["c"] is None and target["t"] is None and target["z"] is not None
