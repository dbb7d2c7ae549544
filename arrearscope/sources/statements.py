"""Derive a client table from order and line-item history.

The six most recent orders of a customer stand for six monthly statements
(rank 1 = most recent), payments are the settled line items of each order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.functions.scalars import seeded_hash
from arrearscope.roles import BILL, PAID, PAY, ROLES, TARGET

MONTHS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _recent_orders(orders: DataFrame) -> DataFrame:
    """At most six orders per customer.

    The rank filter lets Spark keep only the best six per customer inside each
    input partition before the shuffle, so a customer holding a third of all
    orders costs six rows per task and not one giant window partition.
    """
    latest = "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)"
    columns = ("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return orders.selectExpr(*columns, f"{latest} AS month").filter(f"month <= {MONTHS}")


def _settled(lineitem: DataFrame) -> DataFrame:
    """Settled amount per order; decimal, so the sum does not depend on order."""
    amount = "cast(l_extendedprice AS decimal(12,2)) * (1 - cast(l_discount AS decimal(4,2)))"
    return (
        lineitem.filter("l_linestatus = 'F'").groupBy("l_orderkey").agg(F.expr(f"sum({amount}) AS settled"))
    )


#: Repayment status from -2 (nothing due) over -1 (paid in full) to 4 (nothing paid).
STATUS = """CASE WHEN bill <= 0 THEN -2 WHEN paid >= bill THEN -1 WHEN paid >= 0.5D * bill THEN 0
    WHEN paid >= 0.25D * bill THEN 1 WHEN paid >= 0.1D * bill THEN 2 WHEN paid > 0 THEN 3 ELSE 4 END"""


def _statements(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    joined = _recent_orders(orders).join(_settled(lineitem), F.expr("l_orderkey = o_orderkey"), "left")
    still_open = "cast(cast(o_totalprice AS decimal(14,2)) - coalesce(settled, 0) AS double)"
    return joined.selectExpr(
        "o_custkey",
        "month",
        "cast(coalesce(settled, 0) AS double) AS paid",
        f"if(o_orderstatus = 'P', {still_open}, o_totalprice) AS bill",
    ).selectExpr("*", f"{STATUS} AS status")


def _by_month(names: tuple[str, ...], value: str) -> list[Column]:
    return [F.expr(f"max(if(month = {m}, {value}, NULL)) AS {c}") for m, c in enumerate(names, start=1)]


#: The derived client columns; the label is drawn from a hash of the key.
CLIENT = {
    "id": "c_custkey",
    "limit_bal": "if(c_acctbal > 0, cast(cast(c_acctbal AS decimal(12,2)) * 50 AS double), 0D)",
    "age": "if(c_custkey % 53 = 0, NULL, cast(21 + c_custkey % 49 AS int))",
    "education": "cast((c_custkey * 7 + c_nationkey) % 7 AS int)",
    "sex": "if(c_custkey % 97 = 0, 0, cast(1 + c_custkey % 2 AS int))",
    "marriage": "cast(c_nationkey % 4 AS int)",
    TARGET: (
        f"if({seeded_hash('y', 'c_custkey')} / 4294967296D"
        " < 0.06D + if(pay_0 > 0, 0.2D, 0D) + if(pay_2 > 0, 0.15D, 0D), 1, 0)"
    ),
}


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical 25-column client table, one row per customer."""
    wide = (
        _statements(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
        .groupBy("o_custkey")
        .agg(*_by_month(PAY, "status"), *_by_month(BILL, "bill"), *_by_month(PAID, "paid"))
    )
    joined = table(spark, sf_dir, "customer").join(wide, F.expr("o_custkey = c_custkey"), "left")
    return joined.selectExpr(*[f"{CLIENT.get(c, c)} AS {c}" for c in ROLES.ordered])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label ``y``, score ``p`` on a 0.01 grid and group ``grp`` per line item."""
    raw = "0.05D + 3 * l_discount + 0.004D * l_quantity + if(l_returnflag = 'R', 0.15D, 0D)"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "if(l_returnflag = 'R', 1, 0) AS y",
        f"round(least(1D, greatest(0D, {raw})), 2) AS p",
        "l_linestatus AS grp",
    )
