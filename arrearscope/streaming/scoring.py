"""Scoring, quarantine and explanation of application streams.

Everything learned is frozen in the model, so no state, watermark or window is
needed: plain scoring is a projection, and jobs that route rows to two places or
regroup them run per micro-batch. Batch outputs are overwritten per batch id, so
a batch replayed after a failure replaces its own files and counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from arrearscope.operators.explanation import explained
from arrearscope.operators.scoring import RiskModel
from arrearscope.operators.validation import forbid_columns, quarantine
from arrearscope.roles import CLIENT_SCHEMA, FEATURES, ID

#: An application: the id and the model inputs, nothing else.
APPLICATION_SCHEMA = T.StructType([CLIENT_SCHEMA[c] for c in (ID, *FEATURES)])


def read_applications(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A file stream of applications with the closed scoring schema."""
    reader = spark.readStream.schema(APPLICATION_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def score_stream(model: RiskModel, applications: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append scored applications to a parquet folder (exactly once)."""
    forbid_columns(applications, APPLICATION_SCHEMA.fieldNames())
    return (
        model.payload(applications)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _per_batch(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def quarantine_stream(
    model: RiskModel, applications: DataFrame, accepted: str, rejected: str, checkpoint: str
) -> StreamingQuery:
    """Score the valid rows, set the others aside with their broken rules."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid, invalid = quarantine(batch)
            model.payload(valid).write.mode("overwrite").parquet(f"{accepted}/batch={batch_id}")
            invalid.write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")
        finally:
            batch.unpersist()

    return _per_batch(applications, handle, checkpoint)


def explain_stream(model: RiskModel, applications: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Probability, tier, decision and factors of every application."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        explained(model, batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return _per_batch(applications, handle, checkpoint)
