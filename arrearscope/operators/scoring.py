"""Probabilities, tiers, decisions and scores for batches and streams."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.functions.engineered import engineer
from arrearscope.functions.scalars import bounded, name, number, text
from arrearscope.operators.cleaning import clean
from arrearscope.operators.metrics import hard_label
from arrearscope.operators.models import LinearModel, linear_of, positive_probability
from arrearscope.operators.preparation import Preprocessor
from arrearscope.operators.validation import require_columns
from arrearscope.roles import FEATURES, POLICY


def risk_tier(p: str, approve: float, decline: float = POLICY.decline_threshold) -> str:
    """LOW is tested first, so it wins where the thresholds cross."""
    return (
        f"CASE WHEN {p} < {number(float(approve))} THEN 'LOW' "
        f"WHEN {p} < {number(float(decline))} THEN 'MEDIUM' ELSE 'HIGH' END"
    )


def decision(tier: str) -> str:
    made = " ".join(f"WHEN {text(t)} THEN {text(d)}" for t, d in POLICY.decisions.items())
    return f"CASE {tier} {made} END"


def risk_score(p: str) -> str:
    """1000 (1 - p) rounded half to even; higher is safer."""
    return f"cast(bround(1000D * (1D - {bounded(p)}), 0) AS int)"


def scored_columns(
    df: DataFrame, p: str, approve: float, decline: float = POLICY.decline_threshold
) -> DataFrame:
    """Append tier, decision and score for a probability column."""
    tier = risk_tier(name(p), approve, decline)
    return df.selectExpr(
        "*",
        f"{tier} AS risk_tier",
        f"{decision(tier)} AS decision",
        f"{risk_score(name(p))} AS risk_score",
    )


def portfolio(scored: DataFrame) -> DataFrame:
    """Count and mean probability per tier and decision."""
    return scored.groupBy("risk_tier", "decision").agg(
        F.count("*").alias("n"), F.avg("default_probability").alias("mean_probability")
    )


def set_aside(columns) -> str:
    """Input columns as one struct ``_in``, out of the way of feature names.

    Not one alias per column: with two names for every feature Catalyst would
    derive exponentially many constraints from a filter over many features.
    """
    return f"struct({', '.join(map(name, columns))}) AS _in"


@dataclass
class RiskModel:
    """Preprocessing, classifier, calibrator, thresholds and metadata together."""

    prep: Preprocessor
    classifier: Any
    calibrator: Any = None
    approve_threshold: float = 0.5
    decline_threshold: float = POLICY.decline_threshold
    metadata: dict[str, Any] = field(default_factory=dict)

    @property
    def linear(self) -> LinearModel | None:
        """The classifier as a weighted sum, or None if it is not linear."""
        if isinstance(self.classifier, LinearModel):
            return self.classifier
        if isinstance(self.classifier, LogisticRegressionModel):
            return linear_of(self.classifier, self.prep.names)
        return None

    def raw_probability(
        self, df: DataFrame, output: str = "raw_probability", cleaned: bool = False, keep: tuple[str, ...] = ()
    ) -> DataFrame:
        """Uncalibrated probability; every input column is kept.

        A linear model becomes one generated expression. Other models go through
        the feature vector once. ``cleaned`` rows are taken as they are; columns
        in ``keep`` (no features) come last and keep the rows' partitioning.
        """
        require_columns(df, FEATURES)
        inputs = df.selectExpr(*FEATURES, *map(name, keep), set_aside([c for c in df.columns if c not in keep]))
        base = self.prep.encode(engineer(inputs if cleaned else clean(inputs)), keep=(*keep, "_in"))
        if self.linear is not None:
            return base.selectExpr("_in.*", *map(name, keep), f"{self.linear.probability()} AS {name(output)}")
        vector = VectorAssembler(inputCols=self.prep.names, outputCol="features")
        scored = positive_probability(self.classifier, vector.transform(base), output)
        return scored.selectExpr("_in.*", *map(name, keep), name(output))

    def probability(
        self, df: DataFrame, output: str = "default_probability", cleaned: bool = False, keep: tuple[str, ...] = ()
    ) -> DataFrame:
        """Calibrated probability, or the raw one without a calibrator."""
        if self.calibrator is None:
            return self.raw_probability(df, output, cleaned, keep)
        raw = self.raw_probability(df, "_raw", cleaned, keep)
        return self.calibrator.apply(raw, "_raw", output).drop("_raw")

    def predict(self, df: DataFrame, output: str = "label") -> DataFrame:
        scored = self.probability(df, "_p")
        return scored.withColumn(output, hard_label(F.col("_p"), self.approve_threshold)).drop("_p")

    def score(self, df: DataFrame) -> DataFrame:
        """Append default_probability, risk_tier, decision and risk_score."""
        return scored_columns(
            self.probability(df), "default_probability", self.approve_threshold, self.decline_threshold
        )

    def payload(self, df: DataFrame) -> DataFrame:
        """Scored rows as they are handed out: rounded, with the model version."""
        return self.score(df).withColumns(
            {
                "default_probability": F.bround("default_probability", 6),
                "model_version": F.lit(str(self.metadata.get("model_version", "unknown"))),
            }
        )
