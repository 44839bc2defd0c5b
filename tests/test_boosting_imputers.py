"""Boosting with patience and fitted imputers: stops, best rounds, saved models, rows judged alone."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabkiln.operators import flows, impute, models
from tabkiln.operators.boosting import fit_boosted
from tabkiln.plans import fixtures as fx

from conftest import SF_SMALL


def _table(spark, n=600, noise=0.0):
    df = spark.range(n).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("z"),
                               (F.col("id") % 5 == 0).alias("held"))
    df = df.withColumn("_label", F.col("x") * 3 + noise * (F.xxhash64("id") % 100))
    return VectorAssembler(inputCols=["x", "z"], outputCol="_features").transform(df)


def test_boosting_stops_after_patience_and_keeps_the_best_round(spark):
    got = fit_boosted(_table(spark, noise=1.0), F.col("held"), rounds=40, patience=3, step=0.9, maxDepth=4)
    valid = [v for _, _, v in got.history]
    assert got.best_round == min(range(len(valid)), key=valid.__getitem__)
    assert len(valid) - 1 == min(40, got.best_round + 3) and len(got.model.trees) == got.best_round + 1
    assert got.history[got.best_round][1] < got.history[0][1] or got.best_round == 0


@pytest.mark.parametrize("every", [1, 2, 100])
def test_boosting_does_not_depend_on_checkpoints(spark, every):
    got = fit_boosted(_table(spark), F.col("held"), rounds=5, patience=2, step=0.5, maxDepth=3, checkpoint_every=every)
    want = fit_boosted(_table(spark), F.col("held"), rounds=5, patience=2, step=0.5, maxDepth=3, checkpoint_every=3)
    assert [h[0] for h in got.history] == [h[0] for h in want.history]
    assert all(a == pytest.approx(b, abs=1e-9) for g, w in zip(got.history, want.history) for a, b in zip(g, w))


def test_the_model_predicts_what_its_history_says_and_can_be_saved(spark, tmp_path):
    table = _table(spark, noise=0.3)
    got = fit_boosted(table, F.col("held"), rounds=6, patience=6, step=0.4, maxDepth=2)
    rmse = lambda m: m.transform(table).filter("held").agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("_label"), 2)))).first()[0]
    assert rmse(got.model) == pytest.approx(got.history[got.best_round][2], abs=1e-9)
    models.save_model(PipelineModel(stages=[got.model]), str(tmp_path / "m"))
    assert rmse(models.load_model(str(tmp_path / "m"))) == pytest.approx(rmse(got.model), abs=1e-12)
    assert got.model.featureImportances[0] > 0.9


def test_boosting_without_validation_rows_runs_every_round(spark):
    got = fit_boosted(_table(spark), F.lit(False), rounds=4, patience=1, step=0.5, maxDepth=2)
    assert got.best_round == 4 and all(v is None for _, _, v in got.history)


def test_boosting_of_a_constant_label(spark):
    got = fit_boosted(_table(spark).withColumn("_label", F.lit(2.5)), F.col("held"), rounds=5, patience=2)
    assert got.best_round == 0 and got.model.transform(_table(spark)).agg(F.max("prediction")).first()[0] == 2.5


def test_rows_without_a_label_are_in_no_fold(spark):
    df = spark.range(200).select("id", (F.col("id") % 11).cast("double").alias("x"),
                                 F.when(F.col("id") % 2 == 0, F.col("id") % 11 * 2.0).when(F.col("id") % 7 == 1, F.lit(float("nan"))).alias("y"))
    for learner, params in (("lr", {}), ("dt", {"maxDepth": 4}), ("gbt", {"maxIter": 4, "patience": 2, "maxDepth": 3})):
        res = models.cv_regression(df, df, "id", "y", ["x"], learner, 2, params)
        assert res.oof.count() == 100 and res.predictions.count() == 200
        assert all(r["train"] is not None for r in res.metrics.collect())


def test_patience_is_for_boosting_alone(spark):
    df = spark.range(20).select("id", F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    with pytest.raises(ValueError, match="patience"):
        models.cv_regression(df, None, "id", "y", ["x"], "rf", 2, {"patience": 3})


def _gaps(spark):
    r = fx.reg(spark, SF_SMALL)
    kind = F.when(F.col("id") % 6 != 0, F.concat(F.lit("k"), F.col("c1").cast("string")))
    return r.select("id", "x1", "x3", "c1", "n1", "n2", kind.alias("kind"), F.lit("kept").alias("extra"))


@pytest.mark.parametrize("learner", ["rf", "dt"])
def test_a_chain_fills_every_gap_row_by_row(spark, tmp_path, learner):
    df = _gaps(spark)
    chain = impute.fit_imputer(df.filter("id % 2 = 0"), ["kind", "n1", "n2"], learner, categorical=["kind"], exclude=["id"], key="id",
                               num_trees=3, max_depth=5, checkpoint_every=2)
    out = chain.transform(df)
    assert out.columns == df.columns and out.schema == df.schema
    assert out.filter("kind IS NULL OR n1 IS NULL OR n2 IS NULL").count() == 0
    kept = out.alias("o").join(df.alias("d"), "id").filter("d.n1 <> o.n1 OR d.n2 <> o.n2 OR d.kind <> o.kind")
    assert kept.count() == 0
    assert {r[0] for r in out.select("kind").distinct().collect()} == {f"k{i}" for i in range(5)}
    alone = {tuple(r) for r in chain.transform(df.filter("id % 24 = 0")).collect()}
    assert alone == {tuple(r) for r in out.filter("id % 24 = 0").collect()}
    chain.save(spark, str(tmp_path / "chain"))
    again = impute.load_imputer(spark, str(tmp_path / "chain")).transform(df)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in out.collect()}


def test_a_chain_takes_tables_without_gaps_nan_and_missing_features(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3), (2.0, 4.0, 5), (3.0, 6.0, 7), (4.0, 8.0, 9)], "a double, b double, c int")
    chain = impute.fit_imputer(df, ["b", "c"], "dt", features=["a"], max_depth=3)
    new = spark.createDataFrame([(1.0, None, None), (None, float("nan"), 1), (None, None, None)], "a double, b double, c int")
    got = [tuple(r) for r in chain.transform(new).collect()]
    assert got[0] == (1.0, 2.0, 3) and got[1][2] == 1 and got[1][0] is None and all(r[1] is not None and r[2] is not None for r in got)
    assert chain.transform(new.limit(0)).count() == 0
    with pytest.raises(ValueError, match="no usable feature"):
        impute.fit_imputer(df, ["b"], "dt", features=[])
    with pytest.raises(ValueError, match="all set"):
        impute.fit_imputer(new.filter("a IS NULL").withColumn("a", F.when(F.col("c") == 5, 1.0).otherwise(F.when(F.col("c") == 1, 2.0))), ["b"], "dt", features=["a"])


def test_flow_with_an_imputer_scores_one_row_alone(spark, tmp_path):
    raw = _gaps(spark).select("id", "n1", "x3", (F.col("x1") * 0.5).alias("y"))
    paths = flows.train_only(raw, "id", "y", str(tmp_path), {"dt": {"maxDepth": 3}}, imputer="rf", collinear_threshold=2.0)
    every = {r["id"]: r["y_pred_dt"] for r in flows.predict(raw.drop("y"), str(tmp_path), paths).collect()}
    row = raw.drop("y").filter("n1 IS NULL").orderBy("id").limit(1)
    one = flows.predict(row, str(tmp_path), paths).first()
    assert one["y_pred_dt"] == every[one["id"]]


def test_cleaning_fills_each_row_once_for_its_passes(spark, monkeypatch):
    from tabkiln.operators import flows

    plans, fit = [], flows.fit_minmax
    monkeypatch.setattr(flows, "fit_minmax", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or fit(df, *a))
    df = spark.range(200).selectExpr("id", "id * 2.0D AS y", "IF(id % 4 = 0, NULL, id * 1.0D) AS m", "CAST(id % 7 AS DOUBLE) AS w")
    cleaning = flows.fit_cleaning(df, "id", "y", imputer="dt")
    assert len(plans) == 1 and "UDF" not in plans[0]
    assert cleaning.transform(df).filter("m IS NULL OR w IS NULL").isEmpty()
