import json

import pytest

from arrearscope.operators.exploration import schema_listing
from arrearscope.plans import storing
from arrearscope.plans import training as t
from arrearscope.roles import CLIENT_SCHEMA
from arrearscope.sources import bundle, reports, runs
from arrearscope.session import scratch_path


def test_whole_flow(spark, clients):
    budget = t.Budget(
        iterations={"LogisticRegression": 2, "RandomForest": 1},
        folds={"LogisticRegression": 2, "RandomForest": 2},
        overrides={"RandomForest": {"n_estimators": 3, "max_depth": 3}, "DecisionTree": {"max_depth": 3}},
        baselines=("LogisticRegression", "DecisionTree"),
        families=("LogisticRegression", "RandomForest"),
    )
    done = t.train(clients, budget)
    names = {r["model"] for r in done.comparison.collect()}
    assert names == {
        "DummyClassifier", "LogisticRegression", "DecisionTree", "tuned_LogisticRegression", "tuned_RandomForest"
    }
    assert done.selected in ("LogisticRegression", "RandomForest")
    assert done.model.calibrator.method in ("sigmoid", "isotonic")
    assert 0.05 <= done.model.approve_threshold <= 0.80
    test = done.test_metrics.first()
    assert test.n == done.prepared.part("test").count()
    assert {r.attribute for r in done.audit.collect()} == {"sex", "marriage", "age_band"}
    assert done.disparity.count() == 12
    assert done.imbalance.count() == 2
    effect = t.calibration_effect(done.test_scores).first()
    assert abs(effect.improvement - (effect.brier_raw - effect.brier_calibrated)) < 1e-12

    path = bundle.save(spark, done.model, scratch_path(spark, "model"))
    audited = {r.rule: r for r in t.audit_saved_model(bundle.load(spark, path), done.prepared.part("test")).collect()}
    assert set(audited) == {"operating", "f1_optimal"}
    assert audited["operating"].roc_auc == test.roc_auc
    assert audited["f1_optimal"].f1 >= audited["operating"].f1 - 1e-12

    folder, log = scratch_path(spark, "run"), scratch_path(spark, "runs")
    made = storing.store(done, folder, log, repeats=1)
    assert {f"fairness_{a}" for a in ("sex", "marriage", "age_band")} < set(made)
    meta = json.loads(spark.read.text(made["metadata"]).first()[0])
    assert sum(meta["split_sizes"].values()) == meta["dataset"]["n_rows"]
    assert set(meta["baseline_validation_metrics"]) == {"DummyClassifier", "LogisticRegression", "DecisionTree"}
    assert set(meta["tuned_validation_metrics"]) == {"LogisticRegression", "RandomForest"}
    assert set(meta["calibration"]["validation_brier_by_method"]) == {"sigmoid", "isotonic"}
    assert meta["calibration"]["test_brier"] == test.brier_score
    assert len(meta["reference_values"]) == len(meta["feature_columns"]) == 21
    assert spark.read.json(made["test_metrics"]).first().roc_auc == test.roc_auc
    assert spark.read.json(made["fairness_audit"]).count() == done.audit.count()
    assert spark.read.json(made["data_quality_report"]).first().n_rows == meta["dataset"]["n_rows"]
    assert json.loads(spark.read.text(made["threshold_selection"]).first()[0])["operating_threshold"] == done.model.approve_threshold
    assert reports.read_importance(spark, made["feature_importance"]).count() == len(done.prepared.prep.names)
    assert spark.read.option("header", True).csv(made["permutation_importance"]).count() == 21
    best = runs.best_run(runs.read_runs(spark, log)).first()
    assert (best.model_name, best.run_id) == (done.selected, meta["run_id"])
    info = bundle.model_info(spark, bundle.load(spark, made["model"])).first()
    assert None not in info and info.test_metrics["roc_auc"] == test.roc_auc

    again = {r.rule: r for r in t.audit_stored_model(spark, made["model"], clients).collect()}
    assert again["operating"].roc_auc == test.roc_auc
    assert again["operating"].model_version == meta["model_version"]


def test_unknown_split_is_refused(spark, clients, prepared):
    with pytest.raises(ValueError, match="no split"):
        prepared.part("holdout")
    with pytest.raises(ValueError, match="no split"):
        t.audit_stored_model(spark, "nowhere", clients, "holdout")


def test_schema_listing(clients):
    assert schema_listing(clients) == [(f.name, f.dataType.simpleString()) for f in CLIENT_SCHEMA.fields]
