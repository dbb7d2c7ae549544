"""Threshold sweep in one pass, and the choice of the operating point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.functions.scalars import name, number, ratio_or_zero
from arrearscope.operators.metrics import business_cost
from arrearscope.roles import POLICY, Policy


def grid_position(score: str, policy: Policy = POLICY) -> str:
    """Number of grid thresholds at or below a score, as SQL.

    Computed arithmetically, then moved by at most one step after comparing with
    the neighbouring grid values, so a score equal to a threshold is exact.
    """
    grid = policy.grid
    values = f"array({', '.join(number(t) for t in grid)})"
    steps = f"floor(({score} - {number(grid[0])}) / {number(policy.threshold_step)}) + 1"
    guess = f"cast(least(greatest({steps}, 0), {len(grid)}) AS int)"
    too_high = f"coalesce(get({values}, {guess} - 1) > {score}, false)"
    too_low = f"coalesce(get({values}, {guess}) <= {score}, false)"
    return f"{guess} - if({too_high}, 1, 0) + if({too_low}, 1, 0)"


def sweep(df: DataFrame, score: str = "p", label: str = "y", policy: Policy = POLICY) -> DataFrame:
    """Precision, recall, F1, FPR, FNR and cost at every grid threshold.

    The input is reduced to one row per grid cell (77 at most), map-side; the
    suffix sums run over that tiny table. Cells without rows are added so that
    every threshold is reported.
    """
    grid = policy.grid
    cells = df.groupBy(F.expr(grid_position(name(score), policy)).alias("cell")).agg(
        F.expr(f"count_if({name(label)} = 1) AS pos"), F.expr(f"count_if({name(label)} = 0) AS neg")
    )
    every = df.sparkSession.range(len(grid) + 1).selectExpr("cast(id AS int) AS cell", "0L AS pos", "0L AS neg")
    full = cells.unionByName(every).groupBy("cell").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # 77 rows: one task is right here
    counted = full.selectExpr(
        "cell",
        "sum(pos) OVER (ORDER BY cell DESC) AS tp",
        "sum(neg) OVER (ORDER BY cell DESC) AS fp",
        "sum(pos) OVER () AS p_all",
        "sum(neg) OVER () AS n_all",
    ).filter("cell > 0")
    values = f"array({', '.join(number(t) for t in grid)})"
    fn, tn = "(p_all - tp)", "(n_all - fp)"
    return counted.selectExpr(
        f"element_at({values}, cell) AS threshold",
        f"{ratio_or_zero('tp', 'tp + fp')} AS precision",
        f"{ratio_or_zero('tp', f'tp + {fn}')} AS recall",
        f"{ratio_or_zero('2 * tp', f'2 * tp + fp + {fn}')} AS f1",
        f"{ratio_or_zero('fp', f'fp + {tn}')} AS fpr",
        f"{ratio_or_zero(fn, f'{fn} + tp')} AS fnr",
        f"{business_cost(fn, 'fp', policy)} AS expected_cost",
    )


def choose(table: DataFrame) -> DataFrame:
    """F1-optimal and cost-optimal thresholds, the lowest one on a tie."""
    t = F.col("threshold")
    best_f1 = F.max_by(F.struct("threshold", "f1"), F.struct(F.col("f1"), -t))
    best_cost = F.min_by(F.struct("threshold", "f1", "expected_cost"), F.struct(F.col("expected_cost"), t))
    return table.agg(best_f1.alias("f1_row"), best_cost.alias("cost_row")).select(
        F.col("cost_row.threshold").alias("operating_threshold"),
        F.col("f1_row.threshold").alias("f1_optimal_threshold"),
        F.col("cost_row.threshold").alias("cost_optimal_threshold"),
        F.col("cost_row.f1").alias("f1_at_operating"),
        F.col("cost_row.expected_cost").alias("expected_cost_operating"),
        F.lit("business_cost_minimisation").alias("selection_rule"),
    )


def select_threshold(df: DataFrame, score: str = "p", label: str = "y", policy: Policy = POLICY) -> DataFrame:
    return choose(sweep(df, score, label, policy))
