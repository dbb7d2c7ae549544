import pytest
from pyspark.sql import functions as F

from arrearscope.functions.labels import COLUMN_LABELS, label_sql
from arrearscope.operators import explanation as x
from arrearscope.operators.models import LinearModel
from arrearscope.operators.scoring import RiskModel
from arrearscope.plans import scorecard
from arrearscope.plans.training import fit_baseline
from arrearscope.roles import FEATURES


def factors(rows, side):
    return {r.id: [(f.feature, round(f.contribution, 6)) for f in r[side]] for r in rows}


def by_hand(model, df, top_k):
    """One scoring call per feature, joined by id on the driver."""
    from arrearscope.operators.cleaning import clean

    base = {r.id: r.p for r in model.probability(df, "p").collect()}
    up, down = {i: [] for i in base}, {i: [] for i in base}
    for c in FEATURES:
        reset = clean(df).withColumn(c, F.lit(float(model.prep.reference[c])))
        for r in model.probability(reset, "p", cleaned=True).collect():
            change = round(base[r.id] - r.p, 4)
            if change:
                (up if change > 0 else down)[r.id].append((COLUMN_LABELS[c], change))
    key = lambda f: (-abs(f[1]), f[0])
    return ({i: sorted(v, key=key)[:top_k] for i, v in s.items()} for s in (up, down))


def test_ablation_against_one_feature_at_a_time(card, prepared):
    part = prepared.part("test")
    rows = x.ablation_contributions(card, part, top_k=5).collect()
    up, down = by_hand(card, part, 5)
    assert factors(rows, "risk_increasing") == {i: [(f, round(c, 6)) for f, c in v] for i, v in up.items()}
    assert factors(rows, "protective") == {i: [(f, round(c, 6)) for f, c in v] for i, v in down.items()}


def test_ablation_of_a_tree_model(prepared):
    forest = RiskModel(prepared.prep, fit_baseline(prepared, "RandomForest", {"n_estimators": 3, "max_depth": 3}))
    part = prepared.part("test")
    rows = x.ablation_contributions(forest, part).collect()
    up, _ = by_hand(forest, part, 8)
    assert factors(rows, "risk_increasing") == {i: [(f, round(c, 6)) for f, c in v] for i, v in up.items()}


def test_equal_ids_are_explained_row_by_row(card, make_clients):
    df = make_clients({"id": 1}, {"id": 1, "pay_0": 4}, {"id": 1})
    rows = x.ablation_contributions(card, df).collect()
    assert len(rows) == 3 and len({r.default_probability for r in rows}) == 2


def test_variants_are_put_together_without_a_second_shuffle(card, prepared):
    plan = x._exploded_ablation(card, prepared.part("test"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan


def test_a_linear_model_is_explained_without_a_shuffle(card, prepared):
    plan = x.ablation_contributions(card, prepared.part("test"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan and "Python" not in plan, plan


def test_both_forms_of_ablation_agree(card, prepared, make_clients):
    odd = make_clients(
        {}, {}, {c: None for c in FEATURES}, {"limit_bal": 0.0, "education": 9}, {"pay_0": None, "bill_amt1": None, "id": None},
        {f"bill_amt{i}": 0.0 for i in range(1, 7)}, {f"pay_amt{i}": None for i in range(1, 7)}, {"bill_amt1": -1.0, "pay_6": 8},
    )
    plain = RiskModel(card.prep, card.classifier)
    logistic = RiskModel(card.prep, fit_baseline(prepared, "LogisticRegression", {}))
    for model in (card, plain, logistic):
        for df in (odd, prepared.part("test").select(*odd.columns)):
            wide = x._linear_ablation(model, df).selectExpr("_in.*", "default_probability", "_factors").collect()
            long = x._exploded_ablation(model, df).selectExpr("_in.*", "default_probability", "_factors", "_copies").collect()
            key = lambda r: repr((r[: len(odd.columns)], r["default_probability"], sorted(map(tuple, r["_factors"]))))
            assert sorted(map(key, wide)) == sorted(key(r) for r in long for _ in range(r["_copies"]))


def test_other_columns_pass_through_the_explanation(card, make_clients):
    df = make_clients({}, {"pay_0": 3}).selectExpr("*", "'x' AS _z", "'y' AS total_bill_amount", "'z' AS _0_max_delay_months")
    rows = x.ablation_contributions(card, df).collect()
    assert [(r["_z"], r["total_bill_amount"], r["_0_max_delay_months"]) for r in rows] == [("x", "y", "z")] * 2


def test_no_reference_gives_no_factors(card, prepared):
    from dataclasses import replace

    blind = RiskModel(replace(card.prep, reference={}), card.classifier)
    row = x.ablation_contributions(blind, prepared.part("test")).first()
    assert row.risk_increasing == [] and row.protective == []


def test_linear_contributions_add_up(card, prepared):
    part = prepared.part("test")
    wide = x.linear_contributions(card, part, top_k=100).collect()
    raw = {r.id: r.p for r in card.raw_probability(part, "p").collect()}
    import math

    for r in wide:
        total = scorecard.INTERCEPT + sum(f.contribution for f in [*r.risk_increasing, *r.protective])
        assert 1 / (1 + math.exp(-total)) == pytest.approx(raw[r.id], abs=2e-3)
        assert all(f.contribution >= 0 for f in r.risk_increasing)
        assert all(f.contribution <= 0 for f in r.protective)


def test_no_linear_contributions_for_trees(prepared):
    tree = RiskModel(prepared.prep, fit_baseline(prepared, "DecisionTree", {"max_depth": 2}))
    assert x.linear_contributions(tree, prepared.part("test")) is None


def test_importances(spark, prepared, card):
    tree = RiskModel(prepared.prep, fit_baseline(prepared, "DecisionTree", {"max_depth": 3}))
    rows = x.feature_importance(spark, tree).collect()
    assert len(rows) == len(prepared.prep.names)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)
    assert x.top_importances(x.feature_importance(spark, tree)).count() == 20


def test_donors_are_a_permutation_at_any_layout(spark, monkeypatch):
    columns = [f"cast(id AS double) AS {c}" for c in FEATURES]
    df = spark.range(130).selectExpr("id", *columns, "0 AS y")
    found = []
    for rows_per_range, partitions in ((200_000, 1), (40, 4), (7, 16)):
        monkeypatch.setattr(x, "ROWS_PER_RANGE", rows_per_range)
        rows = x._donors(df.repartition(partitions), 3, seed=1).collect()
        assert len(rows) == 130
        found.append({r.id: [d["age"] for d in r.donors] for r in rows})
    assert found[0] == found[1] == found[2]
    for turn in range(3):
        given = [d[turn] for d in found[0].values()]
        assert sorted(given) == sorted(map(float, found[0]))
        assert given != [d[turn - 1] for d in found[0].values()]


def test_importance_does_not_depend_on_the_layout_and_leaves_no_table(spark, card, prepared):
    import os

    from arrearscope.session import scratch_home

    part = prepared.part("test")
    before = set(os.listdir(scratch_home(spark)))
    found = [
        x.permutation_importance(card, part.repartition(n), features=("pay_0", "age"), repeats=2).collect() for n in (1, 4, 16)
    ]
    assert found[0] == found[1] == found[2]
    assert set(os.listdir(scratch_home(spark))) == before


def test_an_unused_column_has_no_importance(prepared):
    only = RiskModel(prepared.prep, LinearModel({"num__pay_0": 1.0, "num__recent_delay_flag": 0.5}, -1.0))
    rows = {r.feature: r for r in x.permutation_importance(only, prepared.table, repeats=2).collect()}
    assert set(rows) == set(FEATURES)
    assert rows["pay_0"].importance_mean > 0.02
    for c in FEATURES:
        if c != "pay_0":
            assert rows[c].importance_mean == 0.0 and rows[c].importance_std == 0.0


def test_labels(spark):
    names = ["num__pay_0", "cat__education_3", "bill_amt4", "net_cash_flow", "num__some_thing", "sex_2", "education", "age_1"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    found = {r.f: r.label for r in df.selectExpr("f", f"{label_sql('f')} AS label").collect()}
    assert [found[n] for n in names] == [
        "repayment status (month -0)", "education level 3", "statement balance (month -4)",
        "net cash flow (repayments - bills)", "some thing", "sex 2", "education level", "age 1",
    ]
    assert found["cat__education_3"] == "education level 3"
    assert found["num__some_thing"] == "some thing"
    assert found["num__pay_0"] == "repayment status (month -0)"
