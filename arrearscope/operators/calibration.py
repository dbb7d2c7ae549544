"""Probability calibration fitted on held-out scores, and its diagnostics."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.functions.pooling import BLOCKS, pool_group, pool_range
from arrearscope.functions.quantiles import exact_quantiles
from arrearscope.functions.scalars import bounded, name, number, sigmoid
from arrearscope.operators.curves import score_counts
from arrearscope.operators.metrics import squared_error
from arrearscope.session import written

METHODS = ("sigmoid", "isotonic")
RELIABILITY_BINS = 10
#: Distinct scores that one task pools first, about.
SCORES_PER_RANGE = 100_000
#: Score ranges whose blocks one task pools together.
RANGES_AT_ONCE = 8


@dataclass(frozen=True)
class SigmoidCalibrator:
    """Logistic curve over the raw probability."""

    slope: float
    intercept: float
    method: str = "sigmoid"

    def apply(self, df: DataFrame, score: str, output: str) -> DataFrame:
        z = f"{number(self.slope)} * {name(score)} + {number(self.intercept)}"
        return df.selectExpr("*", f"{sigmoid(z)} AS {name(output)}")


@dataclass(frozen=True)
class IsotonicCalibrator:
    """Monotone curve, linear between knots and flat beyond the ends."""

    model: Any
    method: str = "isotonic"

    def apply(self, df: DataFrame, score: str, output: str) -> DataFrame:
        model: IsotonicRegressionModel = self.model.copy()
        model.setFeaturesCol("_raw_score").setPredictionCol("_isotonic")
        scored = model.transform(df.withColumn("_raw_score", F.col(score)))
        return scored.withColumn(output, F.expr(bounded("_isotonic"))).drop("_raw_score", "_isotonic")


def _score_table(df: DataFrame, score: str, label: str) -> DataFrame:
    """(p, rate, weight) per distinct score: the fits need no more than that."""
    n = F.col("pos") + F.col("neg")
    return score_counts(df, score, label).select(
        "p", (F.col("pos") / n.cast("double")).alias("rate"), n.cast("double").alias("weight"), "pos", "neg"
    )


def fit_sigmoid(df: DataFrame, score: str = "p", label: str = "y") -> SigmoidCalibrator:
    """One-dimensional logistic regression with the default L2 penalty (C = 1).

    Fitted on weighted distinct scores, which gives the same optimum as the rows.
    """
    table = _score_table(df, score, label)
    sides = F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("pos").cast("double").alias("w")),
        F.struct(F.lit(0.0).alias("label"), F.col("neg").cast("double").alias("w")),
    )
    rows = table.select("p", F.inline(sides)).filter("w > 0")
    rows = VectorAssembler(inputCols=["p"], outputCol="x").transform(rows)
    n = df.agg(F.count(label)).first()[0]
    fitted = LogisticRegression(
        featuresCol="x", labelCol="label", weightCol="w", regParam=1.0 / n,
        elasticNetParam=0.0, standardization=False, maxIter=2000, tol=1e-12,
    ).fit(rows)
    return SigmoidCalibrator(float(fitted.coefficients[0]), float(fitted.intercept))


def pooled_blocks(
    counts: DataFrame, scores_per_range: int = SCORES_PER_RANGE, fan_in: int = RANGES_AT_ONCE
) -> DataFrame:
    """(part, lo, hi, pos, n): the blocks of pool-adjacent-violators over (p, pos, neg) per distinct score.

    Pooled blocks of neighbouring ranges pool to the same blocks as their scores, so
    ranges are pooled on their own first. Then, round by round, those whose borders
    still fall are pooled in groups of ``fan_in``, shifted by half a group every round
    so that every border lies inside a group in one round of two. A block stays in
    the range of its lower end: no task ever holds more than ``fan_in`` ranges, also
    where nothing is pooled, and the driver sees one number per round.
    """
    counts = written(counts.selectExpr("p", "pos", "pos + neg AS n").filter("n > 0"), "score-counts")
    parts = max(1, -(-counts.count() // scores_per_range))
    ranged = counts.repartitionByRange(parts, "p").sortWithinPartitions("p")
    blocks = written(ranged.mapInArrow(pool_range, BLOCKS), "blocks")
    turn = 0
    while True:
        rate = "pos / n"
        # a row per range that holds blocks
        borders = blocks.groupBy("part").agg(F.expr(f"min_by({rate}, lo) AS first"), F.expr(f"max_by({rate}, lo) AS last"))
        order = Window.orderBy("part")
        placed = borders.select(
            "part", (F.lead("first").over(order) <= F.col("last")).alias("falls"), (F.row_number().over(order) - 1).alias("place")
        )
        if not placed.agg(F.count_if("falls")).first()[0]:
            return blocks
        shift = fan_in // 2 if turn % 2 else 0
        groups = placed.select("part", F.expr(f"(place + {shift}) DIV {fan_in}").alias("grp"))
        merged = blocks.join(groups, "part").groupBy("grp").applyInArrow(pool_group, BLOCKS)
        blocks, turn = written(merged, "blocks"), turn + 1


def fit_isotonic(df: DataFrame, score: str = "p", label: str = "y", **kw) -> IsotonicCalibrator:
    """Pool-adjacent-violators over the weighted distinct scores.

    All pooling happens on the executors; the model is made from the two ends of each
    block, which is what a fitted curve consists of.
    """
    blocks = pooled_blocks(score_counts(df, score, label), **kw)
    ends = blocks.selectExpr("explode(array_distinct(array(lo, hi))) AS p", "pos / n AS rate", "cast(n AS double) AS weight")
    fitted = IsotonicRegression(featuresCol="p", labelCol="rate", weightCol="weight", isotonic=True).fit(ends)
    return IsotonicCalibrator(fitted)


FITTERS = {"sigmoid": fit_sigmoid, "isotonic": fit_isotonic}


def fit_calibrator(df: DataFrame, method: str, score: str = "p", label: str = "y"):
    if method not in FITTERS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    return FITTERS[method](df, score, label)


def brier_by_method(df: DataFrame, columns: dict[str, str], label: str = "y") -> DataFrame:
    """(method, brier_score) of several probability columns in one aggregate."""
    wide = df.agg(*[F.expr(f"avg({squared_error(c, label)}) AS {name(m)}") for m, c in columns.items()])
    return wide.unpivot([], list(columns), "method", "brier_score")


def pick_method(briers: DataFrame) -> DataFrame:
    """The method with the lowest Brier score, by name on a tie."""
    return briers.agg(
        F.min_by("method", F.struct("brier_score", "method")).alias("selected"),
        F.min("brier_score").alias("brier_score"),
    )


def calibration_gain(df: DataFrame, raw: str, calibrated: str, label: str = "y") -> DataFrame:
    briers = df.selectExpr(
        f"avg({squared_error(raw, label)}) AS brier_raw",
        f"avg({squared_error(calibrated, label)}) AS brier_calibrated",
    )
    return briers.selectExpr("*", "brier_raw - brier_calibrated AS improvement")


def reliability(
    df: DataFrame, score: str = "p", label: str = "y", bins: int = RELIABILITY_BINS
) -> DataFrame:
    """Mean prediction and observed rate per quantile bin; empty bins vanish.

    A score belongs to the bin numbered by the inner edges strictly below it.
    """
    levels = [i / bins for i in range(1, bins)]
    edges = exact_quantiles(df, [score], levels)[score]
    below = " + ".join(f"if({name(score)} > {number(e)}, 1, 0)" for e in edges)
    return (
        df.groupBy(F.expr(f"cast({below} AS int)").alias("bin"))
        .agg(
            F.count("*").alias("n"),
            F.avg(score).alias("mean_predicted"),
            F.avg(label).alias("observed_rate"),
        )
    )
