import pytest

from arrearscope.operators import validation as v
from arrearscope.roles import FEATURES, TARGET


def test_structural_errors(clients, make_clients):
    with pytest.raises(v.DataValidationError, match="limit_bal"):
        v.check(clients.drop("limit_bal"))
    with pytest.raises(v.DataValidationError, match="not 0 or 1"):
        v.check(make_clients({TARGET: 7}, {}))
    with pytest.raises(v.DataValidationError, match="default rate"):
        v.check(make_clients({}, {}))
    with pytest.raises(v.DataValidationError, match="expected 9"):
        v.check(clients, expected_rows=9)
    with pytest.raises(v.DataValidationError, match="expected 24"):
        v.check(clients, expected_columns=24)
    assert v.check(make_clients({}, {}), strict_prevalence=False).first()["n_defaults"] == 0


def test_unknown_columns_are_refused(clients):
    v.forbid_columns(clients, clients.columns)
    with pytest.raises(v.DataValidationError, match="annual_income"):
        v.forbid_columns(clients.withColumnRenamed("age", "annual_income"), clients.columns)


def test_duplicates_with_null_ids(make_clients):
    df = make_clients({"id": 1}, {"id": 1}, {"id": 1, "age": 50}, {"id": None}, {"id": None}, {"id": 9})
    assert v.duplicate_ids(df).first()[0] == 3
    assert v.duplicate_rows(df).first()[0] == 2


def test_duplicates_under_one_id(spark):
    """A third of all rows under one id and a third without one, in copies and not."""
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, i % 50, None if i % 7 else 0.0, float("nan") if i % 2 else -0.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, a int, b double, c double").repartition(6)
    assert v.duplicate_rows(df).first()[0] == 3000 - df.distinct().count()
    assert v.duplicate_ids(df).first()[0] == 999 + 999
    counts = v.row_counts(df)
    assert counts.agg({"copies": "sum"}).first()[0] == 3000
    plan = v.duplicate_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_nulls_in_other_places_are_other_rows(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (None, None), (1, 1), (None, None)], "a int, b int")
    assert v.duplicate_rows(df).first()[0] == 1
    assert v.duplicate_rows(df.limit(0)).first()[0] == 0


def test_report(make_clients):
    df = make_clients({"sex": 0, "age": None, TARGET: 1}, {"education": 6}, {"education": 5}, {"marriage": None})
    row = v.check(df).first()
    assert row["n_rows"] == 4 and row["n_columns"] == 25 and row["n_features"] == 21
    assert row["missing_by_column"] == {"age": 1, "marriage": 1}
    assert row["n_missing"] == 2
    assert row["out_of_codebook"] == {"sex": {"0": 1}, "education": {"5": 1, "6": 1}}
    assert row["default_rate"] == 0.25


def test_scoring_batch(make_clients):
    v.check_scoring_batch(make_clients({}))
    with pytest.raises(v.DataValidationError, match="empty"):
        v.check_scoring_batch(make_clients({}).filter("id > 5"))
    with pytest.raises(v.DataValidationError, match="no feature"):
        v.check_scoring_batch(make_clients({}, {c: None for c in FEATURES}))


def test_quarantine(make_clients):
    df = make_clients({}, {"age": 5}, {"limit_bal": None, "pay_0": 10}, {"pay_amt1": -1.0}, {"pay_amt1": float("nan")})
    good, bad = v.quarantine(df)
    assert [r.id for r in good.collect()] == [1]
    assert {r.id: r.rejections for r in bad.collect()} == {
        2: ["age:below 18"],
        3: ["limit_bal:missing", "pay_0:above 9"],
        4: ["pay_amt1:below 0"],
        5: ["pay_amt1:missing"],
    }
