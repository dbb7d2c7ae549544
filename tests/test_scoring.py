import pytest

from arrearscope.operators import scoring
from arrearscope.operators.scoring import RiskModel
from arrearscope.plans import scorecard
from arrearscope.roles import FEATURES, TARGET
from arrearscope.sources import bundle
from arrearscope.session import scratch_path


def test_tiers_decisions_and_scores(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.05, 0.2, 0.4, 0.6, 0.9, 1.0, 0.3, 0.0005, 0.0015)], "p double")
    rows = {r.p: r for r in scoring.scored_columns(df, "p", 0.2).collect()}
    assert [rows[p].risk_tier for p in (0.05, 0.2, 0.4, 0.6, 0.9)] == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]
    assert [rows[p].decision for p in (0.05, 0.4, 0.9)] == ["APPROVE", "REVIEW", "DECLINE"]
    assert (rows[0.0].risk_score, rows[1.0].risk_score) == (1000, 0)
    assert rows[0.3].risk_score > rows[0.6].risk_score
    # 999.5 and 998.5 go to the even neighbour
    assert (rows[0.0005].risk_score, rows[0.0015].risk_score) == (1000, 998)


def test_low_wins_where_thresholds_cross(spark):
    df = spark.createDataFrame([(0.65,)], "p double")
    assert scoring.scored_columns(df, "p", 0.7, 0.6).first().risk_tier == "LOW"


def test_score_contract(card, prepared):
    out = card.score(prepared.part("test"))
    assert out.columns == [*prepared.table.columns, "default_probability", "risk_tier", "decision", "risk_score"]
    for r in out.collect():
        assert 0.0 <= r.default_probability <= 1.0 and 0 <= r.risk_score <= 1000
        assert r.decision == {"LOW": "APPROVE", "MEDIUM": "REVIEW", "HIGH": "DECLINE"}[r.risk_tier]


def test_missing_column_is_an_error(card, clients):
    with pytest.raises(ValueError, match="pay_3"):
        card.score(clients.drop("pay_3"))


def test_out_of_codebook_education_is_cleaned_before_scoring(card, make_clients):
    df = make_clients({"education": 6}, {"education": 4})
    a, b = (r.default_probability for r in card.probability(df).orderBy("id").collect())
    assert a == b


def test_predict_and_payload(card, prepared):
    part = prepared.part("test")
    labels = {r.id: r.label for r in card.predict(part).collect()}
    for r in card.payload(part).collect():
        assert r.default_probability == round(r.default_probability, 6)
        assert r.model_version == "test-1"
        assert labels[r.id] == int(r.default_probability >= scorecard.APPROVE)
    bare = RiskModel(card.prep, card.classifier)
    assert bare.payload(part).first().model_version == "unknown"


def test_without_calibrator_the_raw_probability_is_used(card, prepared):
    bare = RiskModel(card.prep, card.classifier)
    part = prepared.part("test")
    raw = bare.raw_probability(part, "p").select("id", "p")
    assert bare.probability(part, "p").select("id", "p").exceptAll(raw).isEmpty()


def test_portfolio(card, prepared):
    rows = scoring.portfolio(card.score(prepared.table)).collect()
    assert sum(r.n for r in rows) == prepared.table.count()


@pytest.mark.parametrize("family", ["LogisticRegression", "DecisionTree", "RandomForest", "BoostedTrees"])
@pytest.mark.parametrize("method", ["isotonic"])
def test_save_and_load(spark, prepared, family, method):
    from arrearscope.operators.calibration import fit_calibrator
    from arrearscope.plans.training import fit_baseline

    params = {"n_estimators": 3, "max_depth": 3, "num_leaves": 15}
    base = RiskModel(prepared.prep, fit_baseline(prepared, family, params))
    scores = base.raw_probability(prepared.part("validation"), "p").selectExpr(f"{TARGET} AS y", "p")
    model = RiskModel(
        prepared.prep, base.classifier, fit_calibrator(scores, method), 0.3, 0.7, {"model_version": "v", "test_metrics": {"n": 3}}
    )
    loaded = bundle.load(spark, bundle.save(spark, model, scratch_path(spark, "model")))
    assert (loaded.approve_threshold, loaded.decline_threshold, loaded.metadata) == (0.3, 0.7, model.metadata)
    part = prepared.part("test").select("id", *FEATURES)
    assert loaded.score(part).exceptAll(model.score(part)).isEmpty()
    info = bundle.model_info(spark, loaded).first()
    assert (info.model_version, info.calibration, info.operating_threshold) == ("v", method, 0.3)
    assert info.test_metrics == {"n": 3.0}


def test_missing_model(spark):
    with pytest.raises(FileNotFoundError):
        bundle.load(spark, scratch_path(spark, "nothing"))
