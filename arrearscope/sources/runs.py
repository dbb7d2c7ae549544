"""Training runs as rows of a table keyed by run id."""

from __future__ import annotations

import secrets
from datetime import UTC, datetime
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("params", _TEXT_MAP),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("dataset_fingerprint", T.StringType()),
        T.StructField("feature_config", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        T.StructField("artifacts", _TEXT_MAP),
        T.StructField("tags", _TEXT_MAP),
    ]
)


def new_run_id(now: datetime | None = None) -> str:
    """Sorts by creation time: microseconds since 1970 and four random letters, base 36."""
    moment = now or datetime.now(UTC)
    ticks = int(moment.timestamp() * 1_000_000)
    return f"run-{np.base_repr(ticks, 36).rjust(11, '0')}{np.base_repr(secrets.randbelow(36**4), 36).rjust(4, '0')}"


def run_row(
    spark: SparkSession,
    model_name: str,
    metrics: dict[str, float],
    params: dict[str, Any] | None = None,
    dataset_fingerprint: str = "",
    feature_config: dict[str, list[str]] | None = None,
    artifacts: dict[str, str] | None = None,
    tags: dict[str, Any] | None = None,
    run_id: str | None = None,
) -> DataFrame:
    def text(values):
        return {k: str(v) for k, v in (values or {}).items()}

    row = (
        run_id or new_run_id(),
        datetime.now(UTC),
        model_name,
        text(params),
        {k: float(v) for k, v in metrics.items() if v is not None},
        dataset_fingerprint,
        feature_config or {},
        text(artifacts),
        text(tags),
    )
    return spark.createDataFrame([row], RUN_SCHEMA)


def append_run(row: DataFrame, path: str) -> None:
    """Log runs; a run that is logged again, as after a repeated job, replaces its own row.

    A run's row lies in a folder of its id, so other runs are never rewritten.
    """
    kept = row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    kept.partitionBy("run_id").json(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).json(path).select(*RUN_SCHEMA.fieldNames())


def best_run(runs: DataFrame, metric: str = "pr_auc") -> DataFrame:
    """The run with the highest metric, the earliest id on a tie."""
    value = F.try_element_at(F.col("metrics"), F.lit(metric))
    return (
        runs.withColumn("value", value).filter("value IS NOT NULL").orderBy(F.desc("value"), "run_id").limit(1)
    )
