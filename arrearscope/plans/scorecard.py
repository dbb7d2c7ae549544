"""A fixed scorecard over the prepared features.

Its weights are constants, so scoring and explaining can be checked against SQL;
the preprocessing around it is still fitted on the data.
"""

from __future__ import annotations

from arrearscope.operators.calibration import SigmoidCalibrator
from arrearscope.operators.models import LinearModel

# Log-odds weights on standardised and one-hot columns.
INTERCEPT = -1.3
WEIGHTS = {
    "num__limit_bal": -0.12,
    "num__age": 0.05,
    "num__pay_0": 0.40,
    "num__pay_2": 0.25,
    "num__pay_3": 0.04,
    "num__bill_amt1": -0.08,
    "num__pay_amt1": -0.06,
    "num__payment_delay_rate": 0.30,
    "num__max_delay_months": 0.15,
    "num__bill_volatility": 0.03,
    "num__payment_to_bill_ratio": -0.10,
    "num__credit_utilization": 0.07,
    "num__bill_trend": -0.02,
    "num__recent_delay_flag": 0.35,
    "cat__education_2": 0.05,
    "cat__education_3": -0.04,
    "cat__education_4": -0.15,
}
SLOPE, OFFSET = 4.0, -2.4
APPROVE, DECLINE = 0.22, 0.60

SCORECARD = LinearModel(WEIGHTS, INTERCEPT)
CALIBRATOR = SigmoidCalibrator(SLOPE, OFFSET)
