from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from arrearscope.operators.scoring import RiskModel  # noqa: E402
from arrearscope.plans import scorecard, training  # noqa: E402
from arrearscope.roles import CLIENT_SCHEMA, ROLES  # noqa: E402
from arrearscope.session import drop_written, local_session, written  # noqa: E402
from arrearscope.sources.statements import panel  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", app="tests")
    yield session
    drop_written(session)


@pytest.fixture(scope="session")
def clients(spark):
    return written(panel(spark, SMALL), "test-clients")


@pytest.fixture(scope="session")
def prepared(clients):
    return training.prepare(clients)


@pytest.fixture(scope="session")
def card(prepared):
    """The fixed scorecard on fitted preprocessing."""
    return RiskModel(
        prepared.prep, scorecard.SCORECARD, scorecard.CALIBRATOR, scorecard.APPROVE, scorecard.DECLINE,
        {"model_version": "test-1"},
    )


#: One plausible applicant with all 21 features.
APPLICANT = {
    **dict(limit_bal=120000.0, age=33, pay_0=-1, pay_2=-1, pay_3=0, pay_4=0, pay_5=-2, pay_6=-2),
    **{f"bill_amt{i}": v for i, v in enumerate((5250.0, 4305.0, 4953.0, 4690.0, 4000.0, 3972.0), start=1)},
    **{f"pay_amt{i}": v for i, v in enumerate((5250.0, 4305.0, 4953.0, 4690.0, 4000.0, 3972.0), start=1)},
    "education": 2,
}


@pytest.fixture(scope="session")
def make_clients(spark):
    """Client rows from partial dictionaries over a plausible applicant."""

    def build(*changes: dict):
        rows = []
        for i, change in enumerate(changes, start=1):
            row = {"id": i, "sex": 1, "marriage": 1, ROLES.target: 0, **APPLICANT, **change}
            rows.append(tuple(row[c] for c in ROLES.ordered))
        return spark.createDataFrame(rows, CLIENT_SCHEMA)

    return build

