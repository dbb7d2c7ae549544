"""The training flow: prepared splits, candidates, calibration, choice, audit."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from arrearscope.operators.calibration import brier_by_method, calibration_gain, fit_calibrator, pick_method
from arrearscope.operators.cleaning import clean
from arrearscope.operators.groups import audit, disparity
from arrearscope.operators.metrics import comparison, metric_rows, metrics
from arrearscope.operators.models import (
    COMPLEXITY,
    Tuned,
    class_weights,
    estimator,
    fit_dummy,
    positive_probability,
    select_final,
    training_frame,
    tune,
)
from arrearscope.operators.preparation import Preprocessor, fit, medians
from arrearscope.operators.scoring import RiskModel
from arrearscope.operators.splitting import with_split
from arrearscope.operators.thresholds import select_threshold
from arrearscope.operators.validation import check
from arrearscope.roles import FEATURES, POLICY, ROLES, SEED, SENSITIVE, SPLIT_FRACTIONS
from arrearscope.session import written
from arrearscope.sources import bundle
from arrearscope.sources.clients import fingerprint
from arrearscope.sources.runs import new_run_id

PROJECT_VERSION = "1.0.0"
BASELINES = ("LogisticRegression", "DecisionTree", "RandomForest", "BoostedTrees")
TUNED_FAMILIES = ("LogisticRegression", "RandomForest", "BoostedTrees")


@dataclass
class Prepared:
    """The cleaned table with a ``split`` column, and what was fitted on train.

    The table is written once, partitioned by split: every later step reads only
    the split and the columns it needs.
    """

    table: DataFrame
    prep: Preprocessor

    def part(self, split: str) -> DataFrame:
        if split not in SPLIT_FRACTIONS:
            raise ValueError(f"no split {split!r}; there are {', '.join(SPLIT_FRACTIONS)}")
        return self.table.filter(F.col("split") == split)

    @cached_property
    def weights(self) -> dict[int, float]:
        """Balanced class weights of the training split."""
        return {r[ROLES.target]: r["weight"] for r in class_weights(self.part("train")).collect()}

    @cached_property
    def frame(self) -> DataFrame:
        """Feature vectors of every split, assembled and written once.

        Iterative fits then re-read plain files: their tasks carry no feature
        expressions, and a lost executor costs a re-read and not a recomputation.
        """
        keep = (ROLES.id, "split")
        return written(training_frame(self.prep, self.table, self.weights, keep), "frame", ("split",))

    def frame_part(self, split: str) -> DataFrame:
        return self.frame.filter(F.col("split") == split)


def prepare(clients: DataFrame, seed: int = SEED) -> Prepared:
    source = written(clean(clients), "clients")
    table = written(with_split(source, seed=seed), "splits", partition_by=("split",))
    return Prepared(table, fit(table.filter("split = 'train'")))


@dataclass(frozen=True)
class Budget:
    """How much to train; the defaults are the full search."""

    iterations: dict[str, int] = field(default_factory=dict)
    folds: dict[str, int] = field(default_factory=dict)
    overrides: dict[str, dict[str, Any]] = field(default_factory=dict)
    baselines: tuple[str, ...] = BASELINES
    families: tuple[str, ...] = TUNED_FAMILIES


def validation_scores(prepared: Prepared, model: Any, split: str = "validation") -> DataFrame:
    """(y, p) of a Spark ML classifier on a split."""
    scored = positive_probability(model, prepared.frame_part(split), "p")
    return scored.select(F.col("label").cast("int").alias("y"), "p")


def fit_baseline(prepared: Prepared, family: str, params: dict[str, Any] | None = None, seed: int = SEED):
    """A classifier of a family with given parameters, fitted on the training split."""
    frame = prepared.frame_part("train")
    return estimator(family, params or {}, frame.count(), seed).fit(frame)


def dummy_scores(prepared: Prepared, split: str = "validation", seed: int = SEED) -> DataFrame:
    model = fit_dummy(prepared.part("train"), seed=seed)
    return prepared.part(split).select(
        F.col(ROLES.target).alias("y"), F.expr(model.probability()).alias("p")
    )


def compare_imbalance(prepared: Prepared, family: str, params: dict[str, Any], seed: int = SEED) -> DataFrame:
    """(strategy, pr_auc) of one family refitted without and with class weights."""
    rows = []
    for strategy, weight in (("unweighted", None), ("class_weight_balanced", "balanced")):
        model = fit_baseline(prepared, family, {**params, "class_weight": weight}, seed)
        value = metrics(validation_scores(prepared, model)).select("pr_auc")
        rows.append(value.select(F.lit(strategy).alias("strategy"), "pr_auc"))
    return rows[0].unionByName(rows[1])


@dataclass
class Training:
    prepared: Prepared
    model: RiskModel
    selected: str
    tuned: dict[str, Tuned]
    comparison: DataFrame
    calibration: DataFrame
    threshold: dict[str, Any]
    test_scores: DataFrame
    test_metrics: DataFrame
    audit: DataFrame
    disparity: DataFrame
    imbalance: DataFrame
    quality: DataFrame


def _values(row: Row, *left_out: str) -> dict[str, Any]:
    return {k: v for k, v in row.asDict().items() if k not in left_out}


def calibrate(prepared: Prepared, base: RiskModel) -> tuple[Any, DataFrame]:
    """Both calibrators on validation; the one with the lower Brier score wins."""
    scores = base.raw_probability(prepared.part("validation"), "p").select(
        F.col(ROLES.target).alias("y"), "p"
    )
    scores = written(scores, "validation-scores")
    fitted = {m: fit_calibrator(scores, m) for m in ("sigmoid", "isotonic")}
    both = scores
    for method, calibrator in fitted.items():
        both = calibrator.apply(both, "p", f"p_{method}")
    briers = brier_by_method(both, {m: f"p_{m}" for m in fitted})
    best = pick_method(briers).first()["selected"]
    return fitted[best], briers


def train(clients: DataFrame, budget: Budget = Budget(), seed: int = SEED) -> Training:
    """The whole flow on a raw client table.

    Only parameters, metric rows and model objects reach the driver.
    """
    # three passes follow, over files and not over what the caller's table is made of
    clients = written(clients, "clients-read")
    quality = written(check(clients), "quality")
    report = quality.first()
    mark = fingerprint(clients).first()["fingerprint"]
    prepared = prepare(clients, seed)

    scored = [("DummyClassifier", metrics(dummy_scores(prepared, seed=seed)))]
    for family in budget.baselines:
        model = fit_baseline(prepared, family, budget.overrides.get(family), seed)
        scored.append((family, metrics(validation_scores(prepared, model))))

    tuned: dict[str, Tuned] = {}
    for family in budget.families:
        tuned[family] = tune(
            family, prepared.frame_part("train"), budget.iterations.get(family),
            budget.folds.get(family), budget.overrides.get(family), seed,
        )
        scored.append((f"tuned_{family}", metrics(validation_scores(prepared, tuned[family].model))))
    compared = written(comparison(scored), "comparison")

    rank = F.create_map(*[F.lit(x) for f in tuned for x in (f"tuned_{f}", COMPLEXITY[f])])
    candidates = compared.filter(F.col("model").startswith("tuned_")).select(
        "model", "pr_auc", rank[F.col("model")].alias("complexity")
    )
    family = select_final(candidates).first()["model"].removeprefix("tuned_")
    winner = tuned[family]
    imbalance = written(compare_imbalance(prepared, family, winner.params, seed), "imbalance")

    base = RiskModel(prepared.prep, winner.model)
    calibrator, briers = calibrate(prepared, base)
    briers = written(briers, "briers")
    calibrated = RiskModel(prepared.prep, winner.model, calibrator)
    on_validation = calibrated.probability(prepared.part("validation"), "p")
    threshold = select_threshold(on_validation, "p", ROLES.target).first().asDict()
    approve = threshold["operating_threshold"]

    test_raw = base.raw_probability(prepared.part("test"), "raw_p")
    test_scores = written(calibrator.apply(test_raw, "raw_p", "p"), "test-scores")
    test_metrics = written(metrics(test_scores, approve, label=ROLES.target), "test-metrics")
    audited = written(audit(test_scores, approve, "p", ROLES.target), "audit")

    values = test_metrics.first().asDict()
    by_model = {r["model"]: _values(r, "model") for r in compared.collect()}
    sizes = {r["split"]: r["count"] for r in prepared.table.groupBy("split").count().collect() if r["split"]}
    run_id = new_run_id()
    # the names are fixed: readers of the stored metadata look them up
    metadata = {
        "model_name": family,
        "model_version": f"{PROJECT_VERSION}+{run_id}",
        "project_version": PROJECT_VERSION,
        "run_id": run_id,
        "trained_at": datetime.now(UTC).isoformat(),
        "random_seed": seed,
        "class_weight": winner.params.get("class_weight") or "none",
        "dataset": {
            "fingerprint": mark,
            "n_rows": report["n_rows"],
            "n_features": report["n_features"],
            "default_rate": report["default_rate"],
        },
        "split_sizes": sizes,
        "feature_columns": list(FEATURES),
        "reference_values": medians(prepared.part("train"), FEATURES),
        "sensitive_columns_excluded": list(SENSITIVE),
        "best_hyperparameters": {f: t.params for f, t in tuned.items()},
        "baseline_validation_metrics": {m: v for m, v in by_model.items() if not m.startswith("tuned_")},
        "tuned_validation_metrics": {m.removeprefix("tuned_"): v for m, v in by_model.items() if m.startswith("tuned_")},
        "imbalance_comparison_validation_pr_auc": {r["strategy"]: r["pr_auc"] for r in imbalance.collect()},
        "calibration": {
            "method": calibrator.method,
            "validation_brier_by_method": {r["method"]: r["brier_score"] for r in briers.collect()},
            "test_brier": values["brier_score"],
        },
        "threshold": threshold,
        "test_metrics": values,
    }
    model = RiskModel(prepared.prep, winner.model, calibrator, approve, POLICY.decline_threshold, metadata)
    return Training(
        prepared, model, family, tuned, compared, briers, threshold, test_scores, test_metrics,
        audited, disparity(audited), imbalance, quality,
    )


def audit_saved_model(model: RiskModel, part: DataFrame, target: str = ROLES.target) -> DataFrame:
    """Metrics of a frozen model on a split, at two thresholds.

    The operating threshold comes with the model; the F1-optimal one is chosen
    on the split itself, as the ``rule`` column says.
    """
    scores = written(
        model.probability(part, "p").select(F.col(target).alias("y"), "p"), "audit-scores"
    )
    f1 = select_threshold(scores).first()["f1_optimal_threshold"]
    operating = model.approve_threshold
    rows = metric_rows(scores, [operating, f1] if f1 != operating else [operating])
    rules = F.array(
        F.when(F.col("threshold") == operating, "operating"), F.when(F.col("threshold") == f1, "f1_optimal")
    )
    return rows.select(F.explode(F.array_compact(rules)).alias("rule"), "*")


def audit_stored_model(spark: SparkSession, path: str, clients: DataFrame, split: str = "test") -> DataFrame:
    """``audit_saved_model`` from a model's folder and a raw client table.

    The split is drawn again as the model's training drew it, by the stored seed;
    a name that is no split raises before anything runs.
    """
    if split not in SPLIT_FRACTIONS:
        raise ValueError(f"no split {split!r}; there are {', '.join(SPLIT_FRACTIONS)}")
    model = bundle.load(spark, path)
    source = written(clean(clients), "clients")
    table = with_split(source, seed=model.metadata.get("random_seed", SEED))
    rows = audit_saved_model(model, table.filter(F.col("split") == split))
    version = F.lit(model.metadata.get("model_version", "unknown"))
    return rows.select("*", F.lit(split).alias("split"), version.alias("model_version"))


def calibration_effect(test_scores: DataFrame, target: str = ROLES.target) -> DataFrame:
    return calibration_gain(test_scores, "raw_p", "p", target)
