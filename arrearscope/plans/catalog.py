"""Every registered query: operator by operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.functions.bands import age_band, group_label
from arrearscope.functions.engineered import ENGINEERED, engineer
from arrearscope.functions.labels import label_sql
from arrearscope.functions.scalars import bounded, name, safe_ratio
from arrearscope.operators import (
    calibration,
    curves,
    explanation,
    exploration,
    groups,
    metrics,
    models,
    preparation,
    scoring,
    splitting,
    thresholds,
    validation,
)
from arrearscope.operators.cleaning import clean, covariates, features_and_target
from arrearscope.plans import scorecard, training
from arrearscope.roles import CATEGORICAL, FEATURES, NUMERIC, ROLES, TARGET
from arrearscope.session import scratch_path, written
from arrearscope.sources import bundle, clients, reports, runs
from arrearscope.sources.statements import panel, scored, table
from arrearscope.streaming import scoring as streams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(key: str):
    def register(run: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = run
        return run

    return register


# -- shared inputs -----------------------------------------------------------------

_shared: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, build):
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _shared:
        _shared[key] = build()
    return _shared[key]


def forget_shared() -> None:
    """Drop the prepared splits and models kept for the session."""
    _shared.clear()


def prepared(spark: SparkSession, sf_dir: str) -> training.Prepared:
    return _once(spark, sf_dir, "prepared", lambda: training.prepare(panel(spark, sf_dir)))


def scorecard_model(spark: SparkSession, sf_dir: str) -> scoring.RiskModel:
    return scoring.RiskModel(
        prepared(spark, sf_dir).prep,
        scorecard.SCORECARD,
        scorecard.CALIBRATOR,
        scorecard.APPROVE,
        scorecard.DECLINE,
        {"model_version": "scorecard-1", "model_name": "scorecard"},
    )


def trained(spark: SparkSession, sf_dir: str, family: str, params: dict) -> scoring.RiskModel:
    ready = prepared(spark, sf_dir)
    fitted = _once(
        spark, sf_dir, f"{family}:{sorted(params.items())}", lambda: training.fit_baseline(ready, family, params)
    )
    return scoring.RiskModel(ready.prep, fitted)


def r(column: str, places: int = 6) -> str:
    """Rounded for display; adding zero turns a negative zero into zero."""
    return f"round({name(column)}, {places}) + 0D AS {name(column)}"


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.selectExpr(*[r(c, places) if c in columns else name(c) for c in df.columns])


def rounded_doubles(df: DataFrame, places: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double" and f.name not in keep]
    return rounded(df, *doubles, places=places)


# -- S: sources and sinks ------------------------------------------------------------


@query("s01_load_raw")
def s01(spark, sf):
    path = scratch_path(spark, "raw")
    clients.to_raw(panel(spark, sf)).write.parquet(path)
    return clients.load_clients(spark, path, "parquet")


@query("s02_rename")
def s02(spark, sf):
    return clients.rename_raw(clients.to_raw(panel(spark, sf)))


@query("s03_project")
def s03(spark, sf):
    shuffled = panel(spark, sf).selectExpr("'x' AS comment", *reversed(ROLES.ordered), "1 AS extra")
    return clients.project_canonical(shuffled)


@query("s04_fingerprint")
def s04(spark, sf):
    return clients.fingerprint(panel(spark, sf))


@query("s05_preview")
def s05(spark, sf):
    return rounded(clients.preview(panel(spark, sf)), "target_rate")


AUDIT_SCHEMA = (
    "attribute string, `group` string, n bigint, n_defaults bigint, base_rate double, selection_rate double, "
    "`precision` double, recall double, false_positive_rate double, false_negative_rate double"
)


@query("s06_csv_reports")
def s06(spark, sf):
    path = reports.write_csv(_audited(spark, sf), scratch_path(spark, "audit"))
    return rounded_doubles(reports.read_report(spark, path, AUDIT_SCHEMA), 9)


@query("s07_json_reports")
def s07(spark, sf):
    counts = ("true_positives", "true_negatives", "false_positives", "false_negatives")
    rows = metrics.metric_rows(scored(spark, sf), [0.5], by=("grp",)).select("grp", *counts)
    return spark.read.text(reports.write_json(rows, scratch_path(spark, "counts")))


def _run_log(spark, sf) -> DataFrame:
    """One run per group of the scored table, logged and read back."""
    rows = metrics.metric_rows(scored(spark, sf), [0.5], by=("grp",)).selectExpr(
        "concat('run-', grp) AS run_id",
        "current_timestamp() AS created_at",
        "concat('fixed_', grp) AS model_name",
        "map('threshold', '0.5') AS params",
        "map('roc_auc', roc_auc, 'pr_auc', pr_auc) AS metrics",
    )
    path = scratch_path(spark, "runs")
    runs.append_run(rows, path)
    return runs.read_runs(spark, path)


@query("s08_run_log")
def s08(spark, sf):
    log = _run_log(spark, sf).selectExpr("run_id", "model_name", "metrics.roc_auc", "metrics.pr_auc")
    return rounded_doubles(log, 9)


@query("s09_best_run")
def s09(spark, sf):
    best = runs.best_run(_run_log(spark, sf)).selectExpr("run_id", "model_name", "value AS pr_auc")
    return rounded(best, "pr_auc", places=9)


@query("s10_model_round_trip")
def s10(spark, sf):
    path = bundle.save(spark, scorecard_model(spark, sf), scratch_path(spark, "model"))
    return _score_columns(bundle.load(spark, path), prepared(spark, sf).table)


def _logistic(spark, sf) -> scoring.RiskModel:
    return trained(spark, sf, "LogisticRegression", {"C": 1.0})


@query("s11_importance_report")
def s11(spark, sf):
    importance = explanation.feature_importance(spark, _logistic(spark, sf))
    return reports.read_importance(spark, reports.write_csv(importance, scratch_path(spark, "importance")))


@query("s12_model_info")
def s12(spark, sf):
    return bundle.model_info(spark, _calibrated_logistic(spark, sf))


# -- V: validation ---------------------------------------------------------------------


@query("v02_invalid_targets")
def v02(spark, sf):
    return validation.invalid_targets(panel(spark, sf))


@query("v03_missing_by_column")
def v03(spark, sf):
    return validation.missing_by_column(panel(spark, sf))


@query("v03_missing_total")
def v03_total(spark, sf):
    return validation.missing_total(panel(spark, sf))


@query("v04_duplicate_rows")
def v04(spark, sf):
    lines = table(spark, sf, "lineitem")
    found = [
        validation.duplicate_rows(panel(spark, sf)).selectExpr("'clients' AS table_name", "*"),
        validation.duplicate_rows(lines).selectExpr("'lineitem' AS table_name", "*"),
    ]
    return found[0].unionByName(found[1])


@query("v05_duplicate_ids")
def v05(spark, sf):
    found = [
        validation.duplicate_ids(panel(spark, sf)).selectExpr("'clients' AS table_name", "*"),
        validation.duplicate_ids(table(spark, sf, "lineitem"), "l_orderkey").selectExpr("'lineitem' AS table_name", "*"),
    ]
    return found[0].unionByName(found[1])


@query("v06_out_of_codebook")
def v06(spark, sf):
    return validation.out_of_codebook(panel(spark, sf))


@query("v07_default_rate")
def v07(spark, sf):
    return rounded(validation.default_rate(panel(spark, sf)), "default_rate")


@query("v08_quality_report")
def v08(spark, sf):
    missing = "transform(array_sort(map_entries(missing_by_column)), e -> concat(e.key, '=', e.value))"
    codes = """flatten(transform(array_sort(map_keys(out_of_codebook)),
        a -> transform(array_sort(map_entries(out_of_codebook[a])), e -> concat(a, '.', e.key, '=', e.value))))"""
    return validation.check(written(panel(spark, sf), "clients")).withColumns(
        {
            "missing_by_column": F.expr(f"array_join({missing}, ';')"),
            "out_of_codebook": F.expr(f"array_join({codes}, ';')"),
        }
    )


@query("v09_scoring_batch")
def v09(spark, sf):
    return validation.scoring_batch_report(panel(spark, sf))


@query("v10_quarantine")
def v10(spark, sf):
    marked = validation.with_rejections(panel(spark, sf))
    return marked.selectExpr("id", "size(rejections) = 0 AS accepted", "array_join(rejections, ';') AS rejections")


# -- C: cleaning -----------------------------------------------------------------------

for _key, _column in (("c01_education", "education"), ("c02_marriage", "marriage"), ("c03_sex", "sex")):
    QUERIES[_key] = lambda spark, sf, c=_column: clean(panel(spark, sf)).select("id", c)


@query("c04_features_target")
def c04(spark, sf):
    return features_and_target(clean(panel(spark, sf)))


@query("c05_covariates")
def c05(spark, sf):
    return covariates(clean(panel(spark, sf)))


@query("c06_clean")
def c06(spark, sf):
    source = written(panel(spark, sf), "clients")
    validation.check(source)
    return clean(source)


# -- E: row-wise features ----------------------------------------------------------------


@query("e00_safe_ratio")
def e00(spark, sf):
    return rounded(
        panel(spark, sf).selectExpr("id", f"{safe_ratio('pay_amt1', 'bill_amt1')} AS ratio"), "ratio"
    )


def _feature_query(column: str) -> Query:
    def run(spark, sf):
        return rounded_doubles(engineer(clean(panel(spark, sf))).select("id", column))

    return run


for _i, _column in enumerate(ENGINEERED, start=1):
    QUERIES[f"e{_i:02d}_{_column}"] = _feature_query(_column)


# -- P: splits -----------------------------------------------------------------------------


@query("p01_split")
def p01(spark, sf):
    clients_table = written(clean(panel(spark, sf)).select("id", TARGET), "keys")
    return splitting.with_split(clients_table).select("id", TARGET, "split")


@query("p03_split_profile")
def p03(spark, sf):
    profile = prepared(spark, sf).table.groupBy("split").agg(
        F.count("*").alias("n"),
        F.expr(f"cast(sum({TARGET}) AS bigint) AS n_defaults"),
        F.avg(TARGET).alias("default_rate"),
        F.count("sex").alias("n_sex"),
        F.count("marriage").alias("n_marriage"),
        F.avg("limit_bal").alias("mean_limit"),
    )
    return rounded_doubles(profile)


@query("p04_folds")
def p04(spark, sf):
    return splitting.with_fold(prepared(spark, sf).part("train"), 5).select("id", "fold")


# -- F: fitted preprocessing -----------------------------------------------------------------


def _train_features(spark, sf) -> DataFrame:
    return engineer(prepared(spark, sf).part("train"))


def _per_feature(spark, rows: list[tuple], columns: str) -> DataFrame:
    return rounded_doubles(spark.createDataFrame(rows, f"feature string, {columns}"))


@query("f01_medians")
def f01(spark, sf):
    found = preparation.medians(_train_features(spark, sf), preparation.SCALED)
    return _per_feature(spark, list(found.items()), "median double")


@query("f02_most_frequent")
def f02(spark, sf):
    return preparation.most_frequent(prepared(spark, sf).part("train"), CATEGORICAL[0])


def _imputed_train(spark, sf) -> tuple[DataFrame, preparation.Preprocessor]:
    prep = prepared(spark, sf).prep
    fill = {c: s.median for c, s in prep.numeric.items()}
    return preparation.imputed(_train_features(spark, sf), fill), prep


@query("f03_winsor_bounds")
def f03(spark, sf):
    imputed, _ = _imputed_train(spark, sf)
    bounds = preparation.winsor_bounds(imputed, preparation.SCALED)
    return _per_feature(spark, [(c, *b) for c, b in bounds.items()], "low double, high double")


@query("f04_clipped")
def f04(spark, sf):
    ready = prepared(spark, sf)
    fill = {c: s.median for c, s in ready.prep.numeric.items()}
    bounds = {c: (s.low, s.high) for c, s in ready.prep.numeric.items()}
    return rounded_doubles(preparation.impute_and_clip(engineer(ready.table), fill, bounds, keep=("id",)))


@query("f05_scaling")
def f05(spark, sf):
    imputed, prep = _imputed_train(spark, sf)
    clipped = preparation.clipped(imputed, {c: (s.low, s.high) for c, s in prep.numeric.items()})
    wide = preparation.means_and_stds(clipped, preparation.SCALED)
    entries = ", ".join(
        f"named_struct('feature', '{c}', 'mean', {c}_mean, 'std', {c}_std)" for c in preparation.SCALED
    )
    return rounded_doubles(wide.selectExpr(f"inline(array({entries}))"))


@query("f06_one_hot")
def f06(spark, sf):
    ready = prepared(spark, sf)
    hot = {c: sql for c, sql in ready.prep.encoded().items() if c.startswith("cat__")}
    return ready.table.selectExpr("id", *[f"{sql} AS {c}" for c, sql in hot.items()])


@query("f07_routed_columns")
def f07(spark, sf):
    routed = engineer(clean(panel(spark, sf))).select(*NUMERIC, *ENGINEERED, *CATEGORICAL)
    return rounded_doubles(routed, keep=FEATURES)


@query("f08_preprocess")
def f08(spark, sf):
    ready = prepared(spark, sf)
    return rounded_doubles(ready.prep.transform(ready.table, keep=("id", "split")), 4)


@query("f09_engineered_step")
def f09(spark, sf):
    step = engineer(clean(panel(spark, sf)).select(*FEATURES))
    return rounded_doubles(step, keep=FEATURES)


@query("f10_feature_names")
def f10(spark, sf):
    names = prepared(spark, sf).prep.names
    return spark.createDataFrame(list(enumerate(names)), "position int, feature string")


@query("f11_reference_medians")
def f11(spark, sf):
    found = preparation.medians(prepared(spark, sf).part("train"), FEATURES)
    return _per_feature(spark, list(found.items()), "median double")


# -- M: models ---------------------------------------------------------------------------------


@query("m01_dummy")
def m01(spark, sf):
    ready = prepared(spark, sf)
    model = models.fit_dummy(ready.part("train"))
    return ready.part("validation").selectExpr("id", f"{model.probability()} AS p")


SMALL_FOREST = {"n_estimators": 20, "max_depth": 6}
SMALL_BOOST = {"n_estimators": 10, "num_leaves": 15}


def _classifier_scores(spark, sf, family: str, params: dict) -> DataFrame:
    part = prepared(spark, sf).part("validation")
    return trained(spark, sf, family, params).raw_probability(part, "p").select("id", TARGET, "p")


@query("m02_logistic_regression")
def m02(spark, sf):
    return _classifier_scores(spark, sf, "LogisticRegression", {"C": 1.0})


def _certified(spark, sf, params: dict) -> DataFrame:
    """Whether every gradient of a model fitted to the end is zero, feature by feature."""
    params = params | {"tol": 1e-12}
    model = trained(spark, sf, "LogisticRegression", params).linear
    found = models.optimality(model, prepared(spark, sf).frame_part("train"), params)
    return found.selectExpr("feature", "round(gradient, 6) + 0D AS gradient", "curvature > 0 AS curved")


@query("m02_optimum")
def m02_optimum(spark, sf):
    return _certified(spark, sf, {"C": 1.0})


@query("m03_decision_tree")
def m03(spark, sf):
    return _classifier_scores(spark, sf, "DecisionTree", {})


@query("m04_random_forest")
def m04(spark, sf):
    return _classifier_scores(spark, sf, "RandomForest", SMALL_FOREST)


@query("m05_boosted_trees")
def m05(spark, sf):
    return _classifier_scores(spark, sf, "BoostedTrees", SMALL_BOOST)


@query("m06_search_trials")
def m06(spark, sf):
    ready = prepared(spark, sf)
    found = models.tune("LogisticRegression", ready.frame_part("train"), iterations=3, folds=3)
    rows = [
        (i, p["C"], p["class_weight"] or "none", float(s), p == found.params)
        for i, (p, s) in enumerate(found.trials)
    ]
    return spark.createDataFrame(
        rows, "trial int, c double, class_weight string, cv_average_precision double, chosen boolean"
    )


@query("m07_class_weights")
def m07(spark, sf):
    return rounded(models.class_weights(prepared(spark, sf).part("train")), "weight")


@query("m08_validation_metrics")
def m08(spark, sf):
    return metrics.metrics(_classifier_scores(spark, sf, "LogisticRegression", {"C": 1.0}), label=TARGET)


def _compared(spark, sf) -> DataFrame:
    ready = prepared(spark, sf)
    card = scorecard_model(spark, sf)
    part = ready.part("validation")
    both = card.calibrator.apply(card.raw_probability(part, "raw_p"), "raw_p", "cal_p")
    return metrics.comparison(
        [
            ("dummy", metrics.metrics(training.dummy_scores(ready))),
            ("raw_scorecard", metrics.metrics(both, score="raw_p", label=TARGET)),
            ("calibrated_scorecard", metrics.metrics(both, score="cal_p", label=TARGET)),
        ]
    )


@query("m09_comparison")
def m09(spark, sf):
    return rounded_doubles(_compared(spark, sf), 4, keep=("threshold",))


@query("m10_selected_model")
def m10(spark, sf):
    rank = "CASE model WHEN 'dummy' THEN -1 WHEN 'raw_scorecard' THEN 0 ELSE 1 END AS complexity"
    return models.select_final(_compared(spark, sf).selectExpr("model", "pr_auc", rank))


@query("m11_imbalance_comparison")
def m11(spark, sf):
    return training.compare_imbalance(prepared(spark, sf), "LogisticRegression", {"C": 1.0})


@query("m11_optima")
def m11_optima(spark, sf):
    found = [
        _certified(spark, sf, {"C": 1.0, "class_weight": weight}).selectExpr(f"'{strategy}' AS strategy", "*")
        for strategy, weight in (("unweighted", None), ("class_weight_balanced", "balanced"))
    ]
    return found[0].unionByName(found[1])


# -- K: calibration ------------------------------------------------------------------------------


def _calibrated_levels(spark, sf, method: str) -> DataFrame:
    source = scored(spark, sf)
    levels = source.groupBy("p").agg(F.count("*").alias("n"))
    return calibration.fit_calibrator(source, method).apply(levels, "p", "calibrated").select("p", "calibrated", "n")


@query("k01_sigmoid")
def k01(spark, sf):
    return rounded(_calibrated_levels(spark, sf, "sigmoid"), "calibrated", places=5)


@query("k02_isotonic")
def k02(spark, sf):
    return rounded(_calibrated_levels(spark, sf, "isotonic"), "calibrated")


@query("k03_bounded")
def k03(spark, sf):
    raw = scorecard_model(spark, sf).raw_probability(prepared(spark, sf).table, "raw_p")
    return rounded(raw.selectExpr("id", f"{bounded('(1.5D * raw_p - 0.2D)')} AS p"), "p")


@query("k04_best_method")
def k04(spark, sf):
    both = source = scored(spark, sf)
    for method in calibration.METHODS:
        both = calibration.fit_calibrator(source, method).apply(both, "p", f"p_{method}")
    briers = calibration.brier_by_method(both, {m: f"p_{m}" for m in calibration.METHODS})
    return rounded(calibration.pick_method(briers), "brier_score")


@query("k05_calibration_gain")
def k05(spark, sf):
    card = scorecard_model(spark, sf)
    raw = card.raw_probability(prepared(spark, sf).part("test"), "raw_p")
    return rounded_doubles(training.calibration_effect(card.calibrator.apply(raw, "raw_p", "p")))


@query("k06_reliability")
def k06(spark, sf):
    return rounded_doubles(calibration.reliability(scored(spark, sf)))


# -- A: evaluation ---------------------------------------------------------------------------------


@query("a01_hard_label")
def a01(spark, sf):
    labelled = scored(spark, sf).withColumn("predicted", metrics.hard_label(F.col("p"), 0.5))
    return labelled.groupBy("y", "p", "predicted").agg(F.count("*").alias("n"))


@query("a02_confusion")
def a02(spark, sf):
    return metrics.confusion(scored(spark, sf))


def _rate_query(*columns: str) -> Query:
    def run(spark, sf):
        return rounded_doubles(metrics.with_rates(metrics.confusion(scored(spark, sf))).select(*columns), 9)

    return run


QUERIES["a03_accuracy"] = _rate_query("accuracy")
QUERIES["a04_precision"] = _rate_query("precision")
QUERIES["a05_recall"] = _rate_query("recall")
QUERIES["a06_specificity"] = _rate_query("specificity")
QUERIES["a07_f1"] = _rate_query("f1")
QUERIES["a08_fpr_fnr"] = _rate_query("false_positive_rate", "false_negative_rate")


@query("a09_roc_auc")
def a09(spark, sf):
    return rounded_doubles(curves.areas(scored(spark, sf)).select("roc_auc"), 9)


@query("a10_average_precision")
def a10(spark, sf):
    return rounded_doubles(curves.areas(scored(spark, sf)).select("pr_auc"), 9)


@query("a11_brier")
def a11(spark, sf):
    return rounded_doubles(metrics.brier(scored(spark, sf)), 9)


@query("a12_log_loss")
def a12(spark, sf):
    return rounded_doubles(metrics.log_loss(scored(spark, sf)), 9)


@query("a13_metric_suite")
def a13(spark, sf):
    return rounded_doubles(metrics.metrics(scored(spark, sf)), 9, keep=("threshold",))


@query("a13_metric_suite_by_group")
def a13_by_group(spark, sf):
    rows = metrics.metric_rows(scored(spark, sf), [0.3, 0.5], by=("grp",))
    return rounded_doubles(rows, 9, keep=("threshold",))


@query("a14_roc_points")
def a14(spark, sf):
    return rounded_doubles(curves.roc_points(scored(spark, sf)), 9, keep=("threshold",))


@query("a15_pr_points")
def a15(spark, sf):
    return rounded_doubles(curves.pr_points(scored(spark, sf)), 9, keep=("threshold",))


@query("a16_business_cost")
def a16(spark, sf):
    return metrics.cost_at(scored(spark, sf), 0.17)


@query("a17_sweep")
def a17(spark, sf):
    return rounded_doubles(thresholds.sweep(scored(spark, sf)), 9, keep=("threshold", "expected_cost"))


@query("a18_thresholds")
def a18(spark, sf):
    return rounded(thresholds.select_threshold(scored(spark, sf)), "f1_at_operating", places=9)


@query("a19_saved_model_audit")
def a19(spark, sf):
    path = bundle.save(spark, scorecard_model(spark, sf), scratch_path(spark, "model"))
    audited = training.audit_stored_model(spark, path, panel(spark, sf))
    return rounded_doubles(audited.select("rule", "split", *metrics.METRICS), keep=("threshold",))


@query("a20_class_distribution")
def a20(spark, sf):
    return rounded(metrics.class_distribution(scored(spark, sf)), "share")


# -- G: group audit ----------------------------------------------------------------------------------


@query("g01_group_metrics")
def g01(spark, sf):
    return rounded_doubles(groups.group_metrics(scored(spark, sf), 0.5), 9)


@query("g02_group_labels")
def g02(spark, sf):
    return panel(spark, sf).selectExpr(
        "id", *[f"{group_label(c)} AS {c}" for c in ("sex", "marriage", "education")]
    )


@query("g03_age_bands")
def g03(spark, sf):
    return panel(spark, sf).selectExpr("id", f"{age_band()} AS age_band")


def _audited(spark, sf) -> DataFrame:
    scores = scorecard_model(spark, sf).probability(prepared(spark, sf).table, "p")
    return groups.audit(scores, scorecard.APPROVE, "p", TARGET)


@query("g04_audit")
def g04(spark, sf):
    return rounded_doubles(_audited(spark, sf), 9)


@query("g05_disparity")
def g05(spark, sf):
    return rounded_doubles(groups.disparity(_audited(spark, sf)))


# -- D: scoring --------------------------------------------------------------------------------------


@query("d01_probability")
def d01(spark, sf):
    card = scorecard_model(spark, sf)
    raw = card.raw_probability(prepared(spark, sf).table)
    both = card.calibrator.apply(raw, "raw_probability", "default_probability")
    return rounded_doubles(both.select("id", "raw_probability", "default_probability"))


@query("d02_predicted_label")
def d02(spark, sf):
    return scorecard_model(spark, sf).predict(prepared(spark, sf).table).select("id", "label")


@query("d03_risk_tier")
def d03(spark, sf):
    tier = scoring.risk_tier("p", scorecard.APPROVE, scorecard.DECLINE)
    return scored(spark, sf).selectExpr("p", f"{tier} AS risk_tier").groupBy("p", "risk_tier").agg(F.count("*").alias("n"))


@query("d04_decision")
def d04(spark, sf):
    made = scoring.decision(scoring.risk_tier("p", scorecard.APPROVE, scorecard.DECLINE))
    return scored(spark, sf).selectExpr("p", f"{made} AS decision").groupBy("p", "decision").agg(F.count("*").alias("n"))


@query("d05_risk_score")
def d05(spark, sf):
    return panel(spark, sf).selectExpr("id", f"{scoring.risk_score('(bill_amt1 / 1e6D)')} AS risk_score")


def _score_columns(model: scoring.RiskModel, df: DataFrame) -> DataFrame:
    columns = ("id", "default_probability", "risk_tier", "decision", "risk_score")
    return rounded(model.score(df).select(*columns), "default_probability")


@query("d06_batch_score")
def d06(spark, sf):
    return _score_columns(scorecard_model(spark, sf), prepared(spark, sf).table)


PAYLOAD = ("id", "default_probability", "risk_tier", "decision", "risk_score", "model_version")


@query("d07_payload")
def d07(spark, sf):
    return scorecard_model(spark, sf).payload(prepared(spark, sf).table).select(*PAYLOAD)


@query("d08_portfolio")
def d08(spark, sf):
    return rounded(scoring.portfolio(scorecard_model(spark, sf).score(prepared(spark, sf).table)), "mean_probability")


def _calibrated_logistic(spark, sf) -> scoring.RiskModel:
    """Logistic regression, the better calibrator and the cost-optimal threshold."""

    def build():
        ready = prepared(spark, sf)
        base = _logistic(spark, sf)
        calibrator, _ = training.calibrate(ready, base)
        model = scoring.RiskModel(ready.prep, base.classifier, calibrator)
        on_validation = model.probability(ready.part("validation"), "p")
        chosen = thresholds.select_threshold(on_validation, "p", TARGET).first()
        model.approve_threshold = chosen["operating_threshold"]
        model.metadata = {"model_name": "LogisticRegression", "model_version": "logistic-1"}
        return model

    return _once(spark, sf, "calibrated-logistic", build)


@query("d09_trained_portfolio")
def d09(spark, sf):
    """Flagship: train, calibrate, choose the threshold, score the whole table."""
    return scoring.portfolio(_calibrated_logistic(spark, sf).score(prepared(spark, sf).table))


# -- X: explanation -----------------------------------------------------------------------------------


@query("x01_native_importance")
def x01(spark, sf):
    return explanation.feature_importance(spark, trained(spark, sf, "RandomForest", SMALL_FOREST))


@query("x02_permutation_importance")
def x02(spark, sf):
    return explanation.permutation_importance(_logistic(spark, sf), prepared(spark, sf).part("test"))


def _long_factors(df: DataFrame) -> DataFrame:
    """(id, direction, place, feature, contribution) from the two factor lists."""
    sides = [
        f"transform({side}, (f, i) -> struct('{side}' AS direction, i + 1 AS place, f.feature AS feature, "
        "f.contribution + 0D AS contribution))"
        for side in ("risk_increasing", "protective")
    ]
    return df.selectExpr("id", f"inline(concat({', '.join(sides)}))")


@query("x03_linear_contributions")
def x03(spark, sf):
    return _long_factors(explanation.linear_contributions(scorecard_model(spark, sf), prepared(spark, sf).table))


@query("x04_ablation")
def x04(spark, sf):
    return _long_factors(explanation.ablation_contributions(scorecard_model(spark, sf), prepared(spark, sf).table))


@query("x06_feature_labels")
def x06(spark, sf):
    ready = prepared(spark, sf)
    long = ready.prep.transform(ready.table).unpivot([], ready.prep.names, "feature", "value")
    means = long.groupBy("feature").agg(F.avg("value").alias("mean_value"))
    return rounded(means.selectExpr("feature", f"{label_sql('feature')} AS label", "mean_value"), "mean_value", places=4)


@query("x07_top_importances")
def x07(spark, sf):
    entries = ", ".join(
        f"named_struct('feature', 'num__{c}', 'importance', abs(corr(cast({c} AS double), cast({TARGET} AS double))))"
        for c in preparation.SCALED
    )
    importance = _train_features(spark, sf).selectExpr(f"array({entries}) AS e").selectExpr("inline(e)")
    top = explanation.top_importances(importance.selectExpr("*", f"{label_sql('feature')} AS label"))
    return rounded(top, "importance")


# -- N: exploration --------------------------------------------------------------------------------------


@query("n01_target_counts")
def n01(spark, sf):
    return exploration.target_counts(panel(spark, sf))


@query("n02_default_rate_by_attribute")
def n02(spark, sf):
    return rounded(exploration.default_rate_by_attribute(panel(spark, sf)), "default_rate")


@query("n03_describe")
def n03(spark, sf):
    return rounded_doubles(exploration.describe(written(panel(spark, sf).select(*exploration.DESCRIBED), "described")))


@query("n04_histograms")
def n04(spark, sf):
    return exploration.histograms(written(panel(spark, sf).select(*exploration.DESCRIBED), "described"))


@query("n05_engineered_means_by_target")
def n05(spark, sf):
    return rounded_doubles(exploration.engineered_means_by_target(panel(spark, sf)))


# -- T: streams --------------------------------------------------------------------------------------------


def _applications(spark, sf) -> DataFrame:
    """The client table as a stream of application files."""
    path = scratch_path(spark, "applications")
    prepared(spark, sf).table.select("id", *FEATURES).write.parquet(path)
    return streams.read_applications(spark, path, files_per_batch=2)


@query("t01_stream_scores")
def t01(spark, sf):
    out = scratch_path(spark, "scores")
    stream = _applications(spark, sf)
    streams.score_stream(scorecard_model(spark, sf), stream, out, scratch_path(spark, "offsets")).awaitTermination()
    return spark.read.parquet(out).select(*PAYLOAD)


@query("t02_stream_quarantine")
def t02(spark, sf):
    path = scratch_path(spark, "applications")
    panel(spark, sf).select("id", *FEATURES).write.parquet(path)
    stream = streams.read_applications(spark, path, files_per_batch=2)
    good, bad = scratch_path(spark, "accepted"), scratch_path(spark, "rejected")
    streams.quarantine_stream(
        scorecard_model(spark, sf), stream, good, bad, scratch_path(spark, "offsets")
    ).awaitTermination()
    accepted = spark.read.parquet(good).selectExpr(
        "id", "true AS accepted", "default_probability", "cast(NULL AS string) AS rejections"
    )
    rejected = spark.read.parquet(bad).selectExpr(
        "id", "false AS accepted", "cast(NULL AS double) AS default_probability", "array_join(rejections, ';') AS rejections"
    )
    return accepted.unionByName(rejected)


@query("t03_stream_explanations")
def t03(spark, sf):
    out = scratch_path(spark, "explained")
    stream = _applications(spark, sf)
    streams.explain_stream(scorecard_model(spark, sf), stream, out, scratch_path(spark, "offsets")).awaitTermination()
    return _long_factors(spark.read.parquet(out))
