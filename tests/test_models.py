import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from arrearscope.operators import calibration, models
from arrearscope.operators.scoring import RiskModel
from arrearscope.plans import training
from arrearscope.roles import TARGET


def newton(x, y, w, c, steps=60):
    """Minimise c * sum of weighted log losses + |b|^2 / 2, intercept free."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(x1.shape[1])
    ridge[-1, -1] = 0
    b = np.zeros(x1.shape[1])
    for _ in range(steps):
        m = 1 / (1 + np.exp(-x1 @ b))
        grad = c * x1.T @ (w * (m - y)) + ridge @ b
        hess = c * (x1 * (w * m * (1 - m))[:, None]).T @ x1 + ridge
        b -= np.linalg.solve(hess, grad)
    return b


@pytest.mark.parametrize("weight", [None, "balanced"])
def test_logistic_regression_has_the_same_optimum(spark, weight):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    y = (rng.random(300) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.0] - 1)))).astype(float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum())) if weight else np.ones(len(y))
    rows = [(Vectors.dense(a), float(b), 1.0, float(c)) for a, b, c in zip(x, y, w)]
    frame = spark.createDataFrame(rows, ["features", "label", models.PLAIN, models.BALANCED])
    fitted = models.estimator("LogisticRegression", {"C": 0.7, "class_weight": weight, "tol": 1e-12}, len(y)).fit(frame)
    expected = newton(x, y, w, 0.7)
    assert np.allclose([*fitted.coefficients, fitted.intercept], expected, atol=1e-5)


def test_the_optimum_is_certified_and_other_weights_are_not(prepared):
    frame, names = prepared.frame_part("train"), prepared.prep.names
    for params in ({"C": 0.5}, {"C": 2.0, "class_weight": "balanced"}):
        fitted = models.estimator("LogisticRegression", params | {"tol": 1e-12}, frame.count()).fit(frame)
        linear = models.linear_of(fitted, names)
        rows = models.optimality(linear, frame, params).collect()
        assert [r.feature for r in rows] == ["intercept", *names]
        assert max(abs(r.gradient) for r in rows) < 1e-6 and min(r.curvature for r in rows) > 0
        moved = models.LinearModel(linear.coefficients | {names[0]: linear.coefficients[names[0]] + 0.1}, linear.intercept)
        assert max(abs(r.gradient) for r in models.optimality(moved, frame, params).collect()) > 1e-3
        other = models.optimality(linear, frame, params | {"C": 50.0}).collect()
        assert max(abs(r.gradient) for r in other) > 1e-5


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 6, f"{TARGET} int")
    assert {r[0]: r.weight for r in models.class_weights(df).collect()} == {1: 2.0, 0: pytest.approx(2 / 3)}


def test_sampled_parameters_are_seeded_and_inside_the_space():
    a = models.sample_parameters("BoostedTrees", 10)
    assert a == models.sample_parameters("BoostedTrees", 10)
    assert a != models.sample_parameters("BoostedTrees", 10, seed=1)
    assert all(0.01 <= d["learning_rate"] <= 0.2 and d["num_leaves"] in (15, 31, 63) for d in a)


def test_selection_prefers_simpler_models_within_tolerance(spark):
    def chosen(*rows):
        return models.select_final(spark.createDataFrame(rows, "model string, pr_auc double, complexity int")).first()["model"]

    assert chosen(("trees", 0.560, 3), ("logistic", 0.556, 0)) == "logistic"
    assert chosen(("trees", 0.560, 3), ("logistic", 0.550, 0)) == "trees"


def test_linear_model_scores_like_spark_ml(prepared):
    fitted = training.fit_baseline(prepared, "LogisticRegression", {"C": 1.0})
    by_ml = models.positive_probability(fitted, prepared.frame, "p").select("id", "p")
    by_expression = RiskModel(prepared.prep, fitted).raw_probability(prepared.table, "q").select("id", "q")
    gap = by_ml.join(by_expression, "id").selectExpr("max(abs(p - q)) AS gap", "count(*) AS n").first()
    assert gap.n == prepared.table.count() and gap.gap < 1e-9


def test_search_runs_every_family(prepared):
    small = {
        "LogisticRegression": {},
        "RandomForest": {"n_estimators": 3, "max_depth": 3},
        "BoostedTrees": {"n_estimators": 2, "num_leaves": 15},
    }
    for family, overrides in small.items():
        found = models.tune(family, prepared.frame_part("train"), iterations=2, folds=2, overrides=overrides)
        assert len(found.trials) == 2
        assert found.cv_score == max(s for _, s in found.trials)


def levels(spark):
    rng = np.random.default_rng(2)
    p = np.round(rng.random(500), 2)
    y = (rng.random(500) < p**2).astype(int)
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double"), y, p


def test_sigmoid_calibration_is_the_penalised_fit(spark):
    df, y, p = levels(spark)
    fitted = calibration.fit_sigmoid(df)
    slope, intercept = newton(p[:, None], y, np.ones(len(y)), 1.0)
    assert fitted.slope == pytest.approx(slope, abs=1e-4)
    assert fitted.intercept == pytest.approx(intercept, abs=1e-4)


def test_isotonic_is_monotone_and_keeps_the_mean(spark):
    df, y, _ = levels(spark)
    out = calibration.fit_isotonic(df).apply(df, "p", "c").orderBy("p").collect()
    values = [r.c for r in out]
    assert all(a <= b + 1e-12 for a, b in zip(values, values[1:]))
    assert np.mean(values) == pytest.approx(y.mean())
    probe = spark.createDataFrame([(-5.0,), (5.0,)], "p double")
    ends = [r.c for r in calibration.fit_isotonic(df).apply(probe, "p", "c").orderBy("p").collect()]
    assert ends == [values[0], values[-1]]


def test_unknown_method_is_refused(spark):
    with pytest.raises(ValueError, match="sigmoid"):
        calibration.fit_calibrator(levels(spark)[0], "beta")


def test_reliability_against_numpy(spark):
    df, y, p = levels(spark)
    edges = np.percentile(p, np.arange(10, 100, 10))
    bins = np.searchsorted(edges, p)
    rows = {r.bin: r for r in calibration.reliability(df).collect()}
    assert set(rows) == set(bins)
    for b in rows:
        assert rows[b].mean_predicted == pytest.approx(p[bins == b].mean())
        assert rows[b].observed_rate == pytest.approx(y[bins == b].mean())
