"""Bucketed prediction tables: the same rows as the union form, without an exchange."""

import uuid

import pytest

from tabkiln.operators import ensemble
from tabkiln.session import checkpoint_dir
from tabkiln.sources import write_bucketed


def _tables(spark):
    truth = spark.range(1000).selectExpr("id", "id * 1.5 as y")
    a = spark.range(0, 1200, 3).selectExpr("id", "id * 1.4 as y_pred_a")
    b = spark.range(0, 1200, 7).selectExpr("id", "if(id % 2 = 0, id * 1.6, null) as y_pred_b")
    c = spark.range(5, 900, 11).selectExpr("id", "id * 1.0 as y_pred_c")
    return truth, a, b, c


def _store(spark, df, buckets=8):
    name = f"t_{uuid.uuid4().hex}"
    return write_bucketed(df, name, f"{checkpoint_dir(spark)}/{name}", "id", buckets)


def test_bucketed_collation_has_no_exchange_and_the_same_rows(spark):
    plain = _tables(spark)
    truth, *preds = [_store(spark, t) for t in plain]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ensemble.collate_bucketed(preds, truth)
        rows = sorted(map(tuple, out.collect()))
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = ensemble.collate(list(plain[1:]), plain[0])
    assert out.columns == want.columns
    assert [str(r) for r in rows] == [str(r) for r in sorted(map(tuple, want.collect()))]


def test_bucketed_collation_of_other_tables_repeated_and_missing_keys(spark):
    truth, a, b, _ = _tables(spark)
    got = ensemble.collate_bucketed({"a": a, "b": _store(spark, b, 4)}, truth)
    assert got.count() == ensemble.collate([a, b], truth).count()
    with pytest.raises(Exception, match="duplicate key"):
        ensemble.collate_bucketed([a.union(a.limit(1))], truth).collect()
    assert ensemble.collate_bucketed([a.limit(0)], truth).count() == 0
    with pytest.raises(ValueError):
        ensemble.collate_bucketed([a, a], truth)
