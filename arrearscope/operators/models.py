"""Classifier families on Spark ML, hyper-parameter search and selection."""

from __future__ import annotations

import math
import random
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.functions.scalars import name, number, seeded_hash, sigmoid, text
from arrearscope.operators.curves import areas
from arrearscope.operators.preparation import Preprocessor
from arrearscope.operators.splitting import with_fold
from arrearscope.roles import POLICY, ROLES, SEED
from arrearscope.session import tidy, written

# Simplicity rank (lower is simpler), search space and budget.
COMPLEXITY = {
    "DummyClassifier": -1,
    "LogisticRegression": 0,
    "DecisionTree": 1,
    "RandomForest": 2,
    "BoostedTrees": 3,
}
SEARCH_SPACE = {
    "LogisticRegression": {"C": (0.01, 10.0), "class_weight": [None, "balanced"]},
    "RandomForest": {
        "max_depth": [None, 8, 12, 18, 24],
        "min_samples_leaf": [1, 2, 4, 8],
        "max_features": ["sqrt", "log2"],
        "class_weight": [None, "balanced"],
    },
    "BoostedTrees": {
        "num_leaves": [15, 31, 63],
        "learning_rate": (0.01, 0.2),
        "n_estimators": [200, 300],
        "min_child_samples": [10, 20, 40],
        "subsample": [0.7, 0.9, 1.0],
        "colsample": [0.6, 0.8, 1.0],
        "class_weight": [None, "balanced"],
    },
}
SEARCH_ITERATIONS = {"LogisticRegression": 12, "RandomForest": 8, "BoostedTrees": 10}
FOLDS = {"LogisticRegression": 5, "RandomForest": 3, "BoostedTrees": 5}
N_ESTIMATORS = 200
MAX_ITER = 4000

#: Deepest tree Spark ML builds; stands for an unlimited depth.
DEEPEST = 30
#: Leaf budgets of best-first trees as depths of level-wise trees.
DEPTH_OF_LEAVES = {15: 4, 31: 5, 63: 6}

LABEL, PLAIN, BALANCED = "label", "w_none", "w_balanced"


# -- training frame --------------------------------------------------------------


def class_weights(df: DataFrame, target: str = ROLES.target) -> DataFrame:
    """(class, n, weight) with weight n / (2 n_class)."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(
        target, "n", (total.cast("double") / (F.lit(2.0) * F.col("n"))).alias("weight")
    )


def training_frame(
    prep: Preprocessor, df: DataFrame, weights: dict[int, float], keep: tuple[str, ...] = (), target: str = ROLES.target
) -> DataFrame:
    """Assembled ``features`` with label and both weight columns."""
    columns = prep.transform(df, keep=(target, *keep))
    assembled = VectorAssembler(inputCols=prep.names, outputCol="features").transform(columns)
    balanced = f"if({name(target)} = 1, {number(weights.get(1, 1.0))}, {number(weights.get(0, 1.0))})"
    return assembled.selectExpr(
        *map(name, keep),
        "features",
        f"cast({name(target)} AS double) AS {LABEL}",
        f"1D AS {PLAIN}",
        f"{balanced} AS {BALANCED}",
    )


# -- classifiers -------------------------------------------------------------------


@dataclass(frozen=True)
class DummyModel:
    """Random 0/1 scores drawn by id with the class prior."""

    prior: float
    seed: int = SEED

    def probability(self, id_column: str = ROLES.id) -> str:
        draw = f"{seeded_hash(self.seed, id_column)} / 4294967296D"
        return f"if({draw} < {number(float(self.prior))}, 1D, 0D)"


def fit_dummy(df: DataFrame, target: str = ROLES.target, seed: int = SEED) -> DummyModel:
    return DummyModel(df.agg(F.avg(target)).first()[0], seed)


@dataclass(frozen=True)
class LinearModel:
    """Log-odds as a weighted sum of named columns, scored without vectors."""

    coefficients: dict[str, float]
    intercept: float

    def terms(self) -> dict[str, str]:
        return {c: f"{number(float(w))} * {name(c)}" for c, w in self.coefficients.items()}

    def log_odds(self) -> str:
        return " + ".join([number(float(self.intercept)), *self.terms().values()])

    def probability(self) -> str:
        return sigmoid(self.log_odds())


def linear_of(model: LogisticRegressionModel, names: list[str]) -> LinearModel:
    return LinearModel(dict(zip(names, map(float, model.coefficients))), float(model.intercept))


def optimality(model: LinearModel, frame: DataFrame, params: dict[str, Any]) -> DataFrame:
    """(feature, gradient, curvature) of the penalised mean loss at a model's weights.

    ``frame`` is what the model was fitted on. The loss is convex and its penalty strictly
    so, hence gradients of zero certify the one optimum; the curvature is the second
    derivative along the weight. The intercept, named so, has no penalty. One aggregate.
    """
    names = list(model.coefficients)
    weight, c = _weight_column(params), float(params.get("C", 1.0))
    w = ", ".join(number(float(model.coefficients[f])) for f in names)
    z = f"aggregate(zip_with(x, array({w}), (a, b) -> a * b), {number(float(model.intercept))}, (s, t) -> s + t)"
    rows = frame.select(vector_to_array("features").alias("x"), LABEL, F.col(weight).alias("w"))
    rows = rows.selectExpr("x", "w", LABEL, f"{sigmoid(z)} AS p").selectExpr("x", f"w * (p - {LABEL}) AS r", "w * p * (1D - p) AS h")
    sums = [
        f"named_struct('feature', {text(f)}, 'gradient', (sum(r * x[{j}]) + {number(float(model.coefficients[f]) / c)}) / count(*), "
        f"'curvature', (sum(h * x[{j}] * x[{j}]) + {number(1.0 / c)}) / count(*))"
        for j, f in enumerate(names)
    ]
    own = "named_struct('feature', 'intercept', 'gradient', sum(r) / count(*), 'curvature', sum(h) / count(*))"
    return rows.selectExpr(f"array({', '.join([own, *sums])}) AS found").selectExpr("inline(found)")


def _weight_column(params: dict[str, Any]) -> str:
    return BALANCED if params.get("class_weight") else PLAIN


def estimator(family: str, params: dict[str, Any], rows: int, seed: int = SEED):
    """A Spark ML estimator for a family's parameters.

    The penalty C acts on the sum of losses, Spark's on their mean, hence
    ``regParam = 1 / (C * rows)``; weights of both kinds sum to ``rows``.
    """
    common = {"featuresCol": "features", "labelCol": LABEL, "weightCol": _weight_column(params)}
    if family == "LogisticRegression":
        return LogisticRegression(
            **common, regParam=1.0 / (params.get("C", 1.0) * rows), elasticNetParam=0.0,
            standardization=False, maxIter=params.get("max_iter", MAX_ITER), tol=params.get("tol", 1e-6),
        )
    if family == "DecisionTree":
        return DecisionTreeClassifier(**common, maxDepth=params.get("max_depth") or DEEPEST, seed=seed)
    if family == "RandomForest":
        return RandomForestClassifier(
            **common, numTrees=params.get("n_estimators", N_ESTIMATORS),
            maxDepth=params.get("max_depth") or DEEPEST,
            minInstancesPerNode=params.get("min_samples_leaf", 1),
            featureSubsetStrategy=params.get("max_features", "sqrt"), seed=seed,
        )
    if family == "BoostedTrees":
        return GBTClassifier(
            **common, maxIter=params.get("n_estimators", N_ESTIMATORS),
            stepSize=params.get("learning_rate", 0.1),
            maxDepth=DEPTH_OF_LEAVES[params.get("num_leaves", 31)],
            minInstancesPerNode=params.get("min_child_samples", 20),
            subsamplingRate=params.get("subsample", 1.0),
            featureSubsetStrategy=str(params.get("colsample", 1.0)), seed=seed,
        )
    raise ValueError(f"unknown family {family!r}")


def positive_probability(model, df: DataFrame, output: str) -> DataFrame:
    """Append the positive-class probability of a fitted Spark ML model."""
    scored = model.transform(df).withColumn(output, vector_to_array("probability")[1])
    return scored.drop("rawPrediction", "probability", "prediction")


# -- search --------------------------------------------------------------------------


def sample_parameters(family: str, iterations: int, seed: int = SEED) -> list[dict[str, Any]]:
    """Seeded draws: a pair of floats is log-uniform, a list a uniform choice."""
    rng = random.Random(f"{seed}:{family}")
    draws = []
    for _ in range(iterations):
        params = {}
        for name, options in SEARCH_SPACE[family].items():
            if isinstance(options, tuple):
                low, high = map(math.log, options)
                params[name] = math.exp(rng.uniform(low, high))
            else:
                params[name] = rng.choice(options)
        draws.append(params)
    return draws


class AveragePrecisionEvaluator(Evaluator):
    """Average precision of the positive-class probability."""

    def _evaluate(self, dataset: DataFrame) -> float:
        scores = dataset.select(
            vector_to_array("probability")[1].alias("p"), F.col(LABEL).cast("int").alias("y")
        )
        with tidy(dataset.sparkSession):
            value = areas(scores).first()["pr_auc"]
        return float("nan") if value is None else float(value)

    def isLargerBetter(self) -> bool:
        return True


@dataclass
class Tuned:
    family: str
    params: dict[str, Any]
    model: Any
    cv_score: float
    trials: list[tuple[dict[str, Any], float]] = field(default_factory=list)


def tune(
    family: str,
    frame: DataFrame,
    iterations: int | None = None,
    folds: int | None = None,
    overrides: dict[str, Any] | None = None,
    seed: int = SEED,
    parallelism: int = 4,
) -> Tuned:
    """Random search by cross-validated average precision, refitted on all rows.

    ``frame`` holds the training rows of :func:`training_frame` with their ids.
    """
    folds = folds or FOLDS[family]
    draws = sample_parameters(family, iterations or SEARCH_ITERATIONS[family], seed)
    draws = [{**d, **(overrides or {})} for d in draws]
    folded = written(with_fold(frame, folds, seed, target=LABEL), "folds")
    rows = frame.count()
    fold_rows = rows - rows // folds  # what one fold's model is fitted on
    base = estimator(family, draws[0], fold_rows, seed)

    def settings(draw: dict[str, Any], n: int) -> dict[str, Any]:
        return {p.name: v for p, v in estimator(family, draw, n, seed).extractParamMap().items()}

    maps = [{base.getParam(k): v for k, v in settings(d, fold_rows).items()} for d in draws]
    search = CrossValidator(
        estimator=base, estimatorParamMaps=maps, evaluator=AveragePrecisionEvaluator(),
        numFolds=folds, foldCol="fold", parallelism=parallelism, seed=seed,
    ).fit(folded)
    scores = list(search.avgMetrics)
    best = max(range(len(scores)), key=lambda i: scores[i])
    # penalties that depend on the number of rows need a refit with all of them
    same = settings(draws[best], rows) == settings(draws[best], fold_rows)
    model = search.bestModel if same else estimator(family, draws[best], rows, seed).fit(frame)
    return Tuned(family, draws[best], model, scores[best], list(zip(draws, scores)))


# -- selection -----------------------------------------------------------------------


def select_final(candidates: DataFrame, tolerance: float = POLICY.selection_tolerance) -> DataFrame:
    """The simplest of the models within ``tolerance`` of the best PR-AUC.

    ``candidates`` has (model, pr_auc, complexity): a few rows, so the best value
    is a scalar subquery over them.
    """
    best = candidates.agg(F.max("pr_auc")).scalar()
    return (
        candidates.filter(F.col("pr_auc") >= best - F.lit(tolerance))
        .orderBy("complexity", F.desc("pr_auc"), "model")
        .limit(1)
    )
