"""A trained model as a folder: parameters as JSON, Spark ML stages beside."""

from __future__ import annotations

import json
from typing import Any

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.operators.calibration import IsotonicCalibrator, SigmoidCalibrator
from arrearscope.operators.models import LinearModel
from arrearscope.operators.preparation import Preprocessor
from arrearscope.operators.scoring import RiskModel
from arrearscope.roles import FEATURES, SENSITIVE

_CLASSIFIERS = {
    cls.__name__: cls
    for cls in (
        LogisticRegressionModel,
        DecisionTreeClassificationModel,
        RandomForestClassificationModel,
        GBTClassificationModel,
    )
}
REQUIRED = ("prep", "classifier", "calibrator", "approve_threshold", "decline_threshold", "metadata")


def _described(model: RiskModel) -> dict[str, Any]:
    classifier = model.classifier
    if isinstance(classifier, LinearModel):
        described = {"kind": "linear", "coefficients": classifier.coefficients, "intercept": classifier.intercept}
    else:
        described = {"kind": type(classifier).__name__}
    calibrator: dict[str, Any] | None = None
    if isinstance(model.calibrator, SigmoidCalibrator):
        calibrator = {
            "method": "sigmoid", "slope": model.calibrator.slope, "intercept": model.calibrator.intercept
        }
    elif model.calibrator is not None:
        calibrator = {"method": model.calibrator.method}
    return {
        "prep": model.prep.to_json(),
        "classifier": described,
        "calibrator": calibrator,
        "approve_threshold": model.approve_threshold,
        "decline_threshold": model.decline_threshold,
        "metadata": model.metadata,
    }


def save(spark: SparkSession, model: RiskModel, path: str) -> str:
    described = _described(model)
    if described["classifier"]["kind"] != "linear":
        model.classifier.write().overwrite().save(f"{path}/classifier")
    if isinstance(model.calibrator, IsotonicCalibrator):
        model.calibrator.model.write().overwrite().save(f"{path}/calibrator")
    # the parameters are written last: a folder with them is complete
    text = json.dumps(described, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/params")
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def load(spark: SparkSession, path: str) -> RiskModel:
    if not _exists(spark, f"{path}/params/_SUCCESS"):
        raise FileNotFoundError(f"no saved model at {path}; train and save one first")
    raw = json.loads(spark.read.text(f"{path}/params").first()[0])
    absent = [k for k in REQUIRED if k not in raw]
    if absent:
        raise TypeError(f"saved model at {path} lacks {absent}")
    kind = raw["classifier"]["kind"]
    if kind == "linear":
        classifier = LinearModel(raw["classifier"]["coefficients"], raw["classifier"]["intercept"])
    elif kind in _CLASSIFIERS:
        classifier = _CLASSIFIERS[kind].load(f"{path}/classifier")
    else:
        raise TypeError(f"saved model at {path} has unknown classifier {kind!r}")
    calibrator = None
    if raw["calibrator"] and raw["calibrator"]["method"] == "sigmoid":
        calibrator = SigmoidCalibrator(raw["calibrator"]["slope"], raw["calibrator"]["intercept"])
    elif raw["calibrator"]:
        calibrator = IsotonicCalibrator(IsotonicRegressionModel.load(f"{path}/calibrator"))
    return RiskModel(
        Preprocessor.from_json(raw["prep"]),
        classifier,
        calibrator,
        raw["approve_threshold"],
        raw["decline_threshold"],
        raw["metadata"],
    )


def model_info(spark: SparkSession, model: RiskModel) -> DataFrame:
    """One row describing the model: version, data, thresholds, calibration."""
    meta = model.metadata
    metrics = {k: float(v) for k, v in (meta.get("test_metrics") or {}).items() if v is not None}
    row = (
        meta.get("model_version"),
        meta.get("model_name"),
        meta.get("trained_at"),
        (meta.get("dataset") or {}).get("fingerprint"),
        list(FEATURES),
        list(SENSITIVE),
        model.approve_threshold,
        model.decline_threshold,
        model.calibrator.method if model.calibrator else None,
        metrics,
    )
    schema = (
        "model_version string, model_name string, trained_at string, dataset_fingerprint string, "
        "feature_columns array<string>, sensitive_columns_excluded array<string>, "
        "operating_threshold double, decline_threshold double, calibration string, "
        "test_metrics map<string,double>"
    )
    return spark.createDataFrame([row], schema).withColumn("n_features", F.size("feature_columns"))
