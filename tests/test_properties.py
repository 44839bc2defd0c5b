"""Randomised properties of the ordered helpers (few examples: each runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabkiln.operators import ordered

_SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@_SETTINGS
@given(keys=st.sets(st.integers(min_value=-10**12, max_value=10**12), min_size=2, max_size=300), k=st.integers(2, 5))
def test_folds_partition_keys_like_ntile(spark, keys, k):
    if len(keys) < k:
        return
    df = spark.createDataFrame([(x,) for x in keys], "key long")
    got = ordered.assign_folds(df, "key", k, rows_per_bucket=37)
    ref = df.withColumn("f_ref", F.ntile(k).over(Window.orderBy("key")) - 1)
    assert got.count() == len(keys)
    assert got.join(ref, "key").filter(F.col("fold") != F.col("f_ref")).count() == 0


@_SETTINGS
@given(keys=st.sets(st.floats(min_value=-1e9, max_value=1e9, allow_nan=False), min_size=1, max_size=300))
def test_row_index_equals_window(spark, keys):
    df = spark.createDataFrame([(x,) for x in keys], "key double")
    got = ordered.add_row_index(df, "key", "ix", rows_per_bucket=29)
    ref = df.withColumn("ix_ref", F.row_number().over(Window.orderBy("key")))
    assert got.join(ref, "key").filter(F.col("ix") != F.col("ix_ref")).count() == 0
