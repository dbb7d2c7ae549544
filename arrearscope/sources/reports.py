"""Report sinks and readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.operators.validation import DataValidationError, require_columns

IMPORTANCE_SCHEMA = "feature string, importance double, label string"


def write_csv(df: DataFrame, path: str) -> str:
    """A small report table as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def as_json(df: DataFrame) -> DataFrame:
    """One JSON document per row, nested values included."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_json(df: DataFrame, path: str) -> str:
    as_json(df).write.mode("overwrite").text(path)
    return path


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    """Stored importances; a report without the three columns is refused."""
    found = spark.read.option("header", True).csv(path)
    try:
        require_columns(found, ("feature", "importance", "label"))
    except DataValidationError as reason:
        raise DataValidationError(f"not an importance report: {path}") from reason
    return found.select("feature", F.col("importance").cast("double").alias("importance"), "label")
