"""What a training run leaves behind: reports, metadata, the model, a run row."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.functions.engineered import ENGINEERED
from arrearscope.operators.explanation import REPEATS, feature_importance, permutation_importance
from arrearscope.operators.scoring import RiskModel
from arrearscope.plans.training import Budget, Training, train
from arrearscope.roles import FEATURES, SEED
from arrearscope.sources import bundle, reports, runs


def _json_row(done: Training, values: dict[str, Any]) -> DataFrame:
    """Values that reached the driver as parameters, as one row of JSON text."""
    spark = done.prepared.table.sparkSession
    return spark.createDataFrame([(json.dumps(values, default=str),)], "value string")


def store(done: Training, folder: str, run_log: str | None = None, repeats: int = REPEATS) -> dict[str, str]:
    """Write a finished training under ``folder``; returns the path of each part.

    Reports and the model come before the run row, so a logged run is complete.
    Importances, which take longest, follow and cannot cost the model. All tables
    are small reports; the permutation scores the test split on the executors.
    """
    spark = done.prepared.table.sparkSession
    meta = done.model.metadata
    made: dict[str, str] = {}

    def csv(name: str, df: DataFrame) -> None:
        made[name] = reports.write_csv(df, f"{folder}/reports/{name}.csv")

    def as_json(name: str, df: DataFrame) -> None:
        made[name] = reports.write_json(df, f"{folder}/reports/{name}.json")

    def text(name: str, values: dict[str, Any], path: str) -> None:
        _json_row(done, values).coalesce(1).write.mode("overwrite").text(path)
        made[name] = path

    for attribute in [r["attribute"] for r in done.audit.select("attribute").distinct().collect()]:
        csv(f"fairness_{attribute}", done.audit.filter(F.col("attribute") == attribute).drop("attribute"))
    csv("fairness_disparity_summary", done.disparity)
    csv("model_comparison_validation", done.comparison)
    as_json("test_metrics", done.test_metrics)
    as_json("fairness_audit", done.audit)
    as_json("data_quality_report", done.quality)
    text("threshold_selection", done.threshold, f"{folder}/reports/threshold_selection.json")
    text("calibration_report", meta["calibration"], f"{folder}/reports/calibration_report.json")
    text("metadata", meta, f"{folder}/metadata.json")
    made["model"] = bundle.save(spark, done.model, f"{folder}/model")

    made["runs"] = run_log or f"{folder}/runs"
    row = runs.run_row(
        spark,
        done.selected,
        meta["test_metrics"],
        {
            "best_hyperparameters": json.dumps(meta["best_hyperparameters"], default=str),
            "threshold": done.model.approve_threshold,
            "calibration_method": meta["calibration"]["method"],
            "class_weight": meta["class_weight"],
        },
        meta["dataset"]["fingerprint"],
        {"features": list(FEATURES), "engineered": list(ENGINEERED)},
        {"model": made["model"], "metadata": made["metadata"]},
        {"model_version": meta["model_version"]},
        meta["run_id"],
    )
    runs.append_run(row, made["runs"])

    csv("feature_importance", feature_importance(spark, done.model))
    raw = RiskModel(done.model.prep, done.model.classifier)
    csv("permutation_importance", permutation_importance(raw, done.prepared.part("test"), repeats=repeats))
    return made


def train_and_store(
    clients: DataFrame, folder: str, run_log: str | None = None, budget: Budget = Budget(), seed: int = SEED
) -> tuple[Training, dict[str, str]]:
    """The whole flow on a raw client table, and everything it leaves in ``folder``."""
    done = train(clients, budget, seed)
    return done, store(done, folder, run_log)
