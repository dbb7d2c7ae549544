import math
import statistics

import pytest

from arrearscope.functions.engineered import ENGINEERED, engineer
from arrearscope.operators.cleaning import clean, covariates, features_and_target
from arrearscope.roles import BILL, FEATURES, PAID, PAY, TARGET


def one(df):
    return engineer(df).first()


def test_all_finite_and_input_unchanged(clients):
    out = engineer(clients)
    assert out.columns == [*clients.columns, *ENGINEERED]
    for row in out.collect():
        for c in ENGINEERED:
            assert row[c] is not None and math.isfinite(row[c]), c
    assert out.select(*clients.columns).exceptAll(clients).isEmpty()


def test_hand_values(make_clients):
    row = one(make_clients({"limit_bal": 10000.0, **{c: 6000.0 for c in BILL}, **{c: -1 for c in PAY}}))
    assert row["credit_utilization"] == pytest.approx(0.6)
    assert row["recent_delay_flag"] == 0
    assert row["pay_duly_rate"] == 1.0
    assert row["bill_volatility"] == 0.0
    late = one(make_clients({"pay_0": 2, **{c: 0 for c in PAY[1:]}}))
    assert late["recent_delay_flag"] == 1
    assert late["max_delay_months"] == 2.0
    assert late["revolving_use_rate"] == pytest.approx(5 / 6)


def test_zero_limit_and_zero_bill(make_clients):
    row = one(make_clients({"limit_bal": 0.0, "bill_amt1": 0.0}))
    assert row["credit_utilization"] == 0.0
    assert row["payment_to_limit_ratio"] == 0.0
    assert row["bill_trend"] == 0.0


def test_missing_history(make_clients):
    row = one(make_clients({c: None for c in (*PAY, *BILL, *PAID)}))
    assert row["max_delay_months"] is None
    assert row["avg_bill_amount"] is None
    assert row["total_bill_amount"] == 0.0
    assert row["payment_delay_rate"] == 0.0
    assert row["bill_volatility"] == 0.0
    assert row["payment_to_bill_ratio"] == 0.0


def test_partial_history(make_clients):
    row = one(make_clients({**{c: None for c in BILL[1:]}, "bill_amt1": 100.0, "pay_0": None}))
    assert row["avg_bill_amount"] == 100.0
    assert row["bill_volatility"] == 0.0
    assert row["recent_delay_flag"] == 0
    two = one(make_clients({**{c: None for c in BILL[2:]}, "bill_amt1": 100.0, "bill_amt2": 300.0}))
    assert two["bill_volatility"] == pytest.approx(statistics.stdev([100.0, 300.0]))


def test_trend_is_oldest_minus_newest(make_clients):
    row = one(make_clients({"bill_amt1": -200.0, "bill_amt6": 100.0}))
    assert row["bill_trend"] == pytest.approx(1.5)


def test_clean_codes(make_clients):
    df = make_clients(
        {"education": 0, "marriage": 0, "sex": 0},
        {"education": None, "marriage": None, "sex": None},
        {"education": 3, "marriage": 2, "sex": 2},
    )
    rows = [(r.education, r.marriage, r.sex) for r in clean(df).orderBy("id").collect()]
    assert rows == [(4, 3, None), (4, 3, None), (3, 2, 2)]
    assert clean(df).schema == df.schema


def test_projections(clients):
    assert features_and_target(clients).columns == [*FEATURES, TARGET]
    assert covariates(clients).columns == ["id", "sex", "marriage"]
    assert covariates(clients.drop("sex")).columns == ["id", "marriage"]
