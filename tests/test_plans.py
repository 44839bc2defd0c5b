"""Physical-plan shape of key queries: the scale properties, not just the results."""

import re

from tabkiln.plans.registry import queries

from conftest import SF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_collation_is_one_shuffle_with_pruned_scans(spark):
    plan = _plan(queries()["ensemble_collate"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "SortMergeJoin" not in plan
    for schema in re.findall(r"ReadSchema: (struct<[^>]*>)", plan):
        assert schema == "struct<o_orderkey:bigint,o_totalprice:double>"


def test_category_tuning_reads_data_once(spark):
    # the only join is the fixture's documents-labels join; metrics at the tuned
    # thresholds come from the histogram sweep, not from a join back
    for name in ("category_report", "tuned_overall_metrics"):
        plan = _plan(queries()[name](spark, SF))
        assert len(re.findall(r"Join", plan)) == 1, name
        assert len(re.findall(r"Scan parquet", plan)) == 2, name


def test_splits_are_projections(spark):
    for name in ("holdout_split", "three_way_split", "kfold_assign", "segment_group_split"):
        plan = _plan(queries()[name](spark, SF))
        assert "Join" not in plan, name
        assert "Exchange" not in plan, name
        assert "Window" not in plan, name


def test_text_windows_need_no_shuffle(spark):
    plan = _plan(queries()["text_windows"](spark, SF))
    assert "Exchange" not in plan
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string,lang:string>|ReadSchema: struct<doc_id:bigint,lang:string,text:string>", plan)


def test_no_python_udfs_in_registered_queries(spark):
    from conftest import SF_SMALL

    learners = {
        "impute_rf", "impute_dt_categorical", "feature_importance", "feature_importance_classifier",
        "important_features", "cv_regression", "cv_metrics", "cv_importance", "load_predict",
        "fit_predict_collate", "pca_features",
    }
    bad = []
    for name, fn in sorted(queries().items()):
        if name in learners:
            continue
        plan = _plan(fn(spark, SF_SMALL))
        if re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|PythonUDF|FlatMapGroupsInPandas", plan):
            bad.append(name)
    assert bad == []
