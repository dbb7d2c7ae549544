"""The registered queries as a set, and the plans behind the scale claims."""

from glob import glob
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import check
from arrearscope.operators import splitting
from arrearscope.plans import catalog
from arrearscope.roles import ROLES
from arrearscope.sources.statements import panel

from conftest import SMALL

#: Iterative fits and model tables: rows only.
WITHOUT_SQL = {
    "s11_importance_report", "s12_model_info", "m02_logistic_regression", "m03_decision_tree",
    "m04_random_forest", "m05_boosted_trees", "m06_search_trials", "m08_validation_metrics",
    "m11_imbalance_comparison", "d09_trained_portfolio", "x01_native_importance", "x02_permutation_importance",
}


def test_every_other_query_has_sql():
    assert set(catalog.QUERIES) - set(entry.oracle_sql()) == WITHOUT_SQL
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize(
    "key",
    [
        "n05_engineered_means_by_target", "s04_fingerprint", "v08_quality_report", "v10_quarantine", "p01_split",
        "f08_preprocess", "a13_metric_suite_by_group", "a17_sweep", "a19_saved_model_audit", "g04_audit",
        "k01_sigmoid", "k02_isotonic", "x03_linear_contributions", "x04_ablation", "n04_histograms",
    ],
)
def test_query_equals_sql(spark, duck, key):
    line = check.compare(spark, duck, key, SMALL, entry.oracle_sql()[key])
    assert line.startswith("ok"), line


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert sum(r.n for r in rows) == 150


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_customers_are_cut_before_the_shuffle(spark):
    plan = plan_of(panel(spark, SMALL))
    assert plan.count("WindowGroupLimit") == 2  # before and after the exchange
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)" in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(catalog.scored(spark, SMALL).select("y"))
    assert "ReadSchema: struct<l_returnflag:string>" in plan


def test_a_split_is_a_projection(spark, clients):
    assert "Exchange" not in plan_of(splitting.with_split(clients).select("id", "split"))


def test_no_python_on_the_row_path(spark, card, clients):
    for df in (card.score(clients), card.prep.transform(clients), splitting.with_fold(clients, 3)):
        plan = plan_of(df)
        assert "Python" not in plan and "Pandas" not in plan


def test_scoring_is_a_projection(card, clients):
    assert "Exchange" not in plan_of(card.payload(clients.select(*ROLES.ordered)))
