"""Seventeen row-wise delinquency, exposure and repayment features."""

from __future__ import annotations

from pyspark.sql import DataFrame

from arrearscope.functions.scalars import (
    count_present,
    safe_ratio,
    sample_std,
    share_of_months,
    sum_present,
)
from arrearscope.roles import BILL, LIMIT, PAID, PAY

# Output names in output order.
ENGINEERED = (
    "payment_delay_rate",
    "serious_delay_rate",
    "max_delay_months",
    "pay_duly_rate",
    "revolving_use_rate",
    "total_bill_amount",
    "avg_bill_amount",
    "bill_volatility",
    "total_payment_amount",
    "avg_payment_amount",
    "payment_volatility",
    "net_cash_flow",
    "payment_to_bill_ratio",
    "credit_utilization",
    "payment_to_limit_ratio",
    "bill_trend",
    "recent_delay_flag",
)

_WORST = f"cast(greatest({', '.join(PAY)}) AS double)"

#: Features over the statement columns alone.
FROM_STATEMENTS = {
    "payment_delay_rate": share_of_months(PAY, "> 0"),
    "serious_delay_rate": share_of_months(PAY, ">= 2"),
    # greatest() skips nulls, so only an all-null history stays null
    "max_delay_months": f"CASE WHEN {_WORST} IS NOT NULL THEN greatest({_WORST}, 0D) END",
    "pay_duly_rate": share_of_months(PAY, "IN (-1, -2)"),
    "revolving_use_rate": share_of_months(PAY, "= 0"),
    "recent_delay_flag": f"if({PAY[0]} > 0, 1, 0)",
    "total_bill_amount": sum_present(BILL),
    "total_payment_amount": sum_present(PAID),
    # positive means the balance fell: oldest minus newest, over newest
    "bill_trend": safe_ratio(f"({BILL[-1]} - {BILL[0]})", f"abs({BILL[0]})"),
}
#: Features over the totals.
FROM_TOTALS = {
    "avg_bill_amount": f"try_divide(total_bill_amount, cast({count_present(BILL)} AS double))",
    "avg_payment_amount": f"try_divide(total_payment_amount, cast({count_present(PAID)} AS double))",
    "net_cash_flow": "total_payment_amount - total_bill_amount",
    "payment_to_bill_ratio": safe_ratio("total_payment_amount", "total_bill_amount"),
}
#: Features over the averages.
FROM_AVERAGES = {
    "bill_volatility": sample_std(BILL, "avg_bill_amount"),
    "payment_volatility": sample_std(PAID, "avg_payment_amount"),
    "credit_utilization": safe_ratio("avg_bill_amount", LIMIT),
    "payment_to_limit_ratio": safe_ratio("avg_payment_amount", LIMIT),
}

#: A stage's features need the columns of the table and of the stages before it.
STAGES = (FROM_STATEMENTS, FROM_TOTALS, FROM_AVERAGES)


def _append(df: DataFrame, features: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{sql} AS {c}" for c, sql in features.items()])


def engineer(df: DataFrame) -> DataFrame:
    """Append :data:`ENGINEERED`; existing columns pass through unchanged.

    Three projections: no shuffle, no Python on the row path, and each
    intermediate is named once. Unused features are pruned with their inputs.
    """
    kept = [c for c in df.columns if c not in ENGINEERED]
    staged = _append(_append(_append(df.select(*kept), FROM_STATEMENTS), FROM_TOTALS), FROM_AVERAGES)
    return staged.select(*kept, *ENGINEERED)
