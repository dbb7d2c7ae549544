"""Classification metrics from aggregate counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearscope.functions.scalars import name, number, ratio_or_zero
from arrearscope.operators.curves import AVERAGE_PRECISION, ROC_AUC, ranked_counts
from arrearscope.roles import POLICY, Policy

LOG_LOSS_CLIP = 1e-15

# Metric names, and those rounded in the comparison table.
METRICS = (
    "threshold",
    "accuracy",
    "precision",
    "recall",
    "specificity",
    "f1",
    "roc_auc",
    "pr_auc",
    "false_positive_rate",
    "false_negative_rate",
    "brier_score",
    "log_loss",
    "true_positives",
    "true_negatives",
    "false_positives",
    "false_negatives",
    "n",
    "n_defaults",
)
ROUNDED = (
    "accuracy",
    "precision",
    "recall",
    "specificity",
    "f1",
    "roc_auc",
    "pr_auc",
    "brier_score",
    "log_loss",
    "false_positive_rate",
    "false_negative_rate",
)

_TP, _TN, _FP, _FN = "true_positives", "true_negatives", "false_positives", "false_negatives"

#: Every rate over the four confusion counts.
RATES = {
    "accuracy": ratio_or_zero(f"{_TP} + {_TN}", f"{_TP} + {_TN} + {_FP} + {_FN}"),
    "precision": ratio_or_zero(_TP, f"{_TP} + {_FP}"),
    "recall": ratio_or_zero(_TP, f"{_TP} + {_FN}"),
    "specificity": ratio_or_zero(_TN, f"{_TN} + {_FP}"),
    "f1": ratio_or_zero(f"2 * {_TP}", f"2 * {_TP} + {_FP} + {_FN}"),
    "false_positive_rate": ratio_or_zero(_FP, f"{_FP} + {_TN}"),
    "false_negative_rate": ratio_or_zero(_FN, f"{_FN} + {_TP}"),
}


def hard_label(score: Column, threshold: float) -> Column:
    """1 at or above the threshold."""
    return F.when(score >= F.lit(threshold), 1).otherwise(0)


def confusion(df: DataFrame, score: str = "p", label: str = "y", threshold: float = 0.5) -> DataFrame:
    flag, y = f"({name(score)} >= {number(float(threshold))})", f"({name(label)} = 1)"
    return df.selectExpr(
        f"count_if({flag} AND {y}) AS {_TP}",
        f"count_if(NOT {flag} AND NOT {y}) AS {_TN}",
        f"count_if({flag} AND NOT {y}) AS {_FP}",
        f"count_if(NOT {flag} AND {y}) AS {_FN}",
        "count(*) AS n",
        f"count_if({y}) AS n_defaults",
    )


def with_rates(counts: DataFrame) -> DataFrame:
    return counts.selectExpr("*", *[f"{sql} AS {c}" for c, sql in RATES.items()])


def squared_error(score: str = "p", label: str = "y") -> str:
    return f"(({name(score)} - {name(label)}) * ({name(score)} - {name(label)}))"


def brier(df: DataFrame, score: str = "p", label: str = "y") -> DataFrame:
    return df.selectExpr(f"avg({squared_error(score, label)}) AS brier_score")


def _log_terms(p: str) -> tuple[str, str]:
    inside = f"least(greatest({p}, {number(LOG_LOSS_CLIP)}), {number(1 - LOG_LOSS_CLIP)})"
    return f"ln({inside})", f"ln(1D - {inside})"


def log_loss(df: DataFrame, score: str = "p", label: str = "y") -> DataFrame:
    if_pos, if_neg = _log_terms(name(score))
    return df.selectExpr(f"-avg(if({name(label)} = 1, {if_pos}, {if_neg})) AS log_loss")


def metric_rows(
    df: DataFrame,
    thresholds: list[float],
    score: str = "p",
    label: str = "y",
    by: tuple[str, ...] = (),
    **kw,
) -> DataFrame:
    """The whole suite, one row per threshold (and group), from one curve pass.

    Everything is computed from the distinct-score counts, so all thresholds and
    both areas share a single reduction of the input.
    """
    if_pos, if_neg = _log_terms("p")

    def counts(t: float) -> str:
        flag = f"p >= {number(float(t))}"
        return (
            f"named_struct('threshold', {number(float(t))}, "
            f"'{_TP}', sum(if({flag}, pos, 0L)), '{_TN}', sum(if({flag}, 0L, neg)), "
            f"'{_FP}', sum(if({flag}, neg, 0L)), '{_FN}', sum(if({flag}, 0L, pos)))"
        )

    summary = ranked_counts(df, score, label, by, **kw).groupBy(*by).agg(
        F.expr(f"{ROC_AUC} AS roc_auc"),
        F.expr(f"{AVERAGE_PRECISION} AS pr_auc"),
        F.expr("sum(pos * (p - 1D) * (p - 1D) + neg * p * p) / sum(pos + neg) AS brier_score"),
        F.expr(f"-sum(pos * {if_pos} + neg * {if_neg}) / sum(pos + neg) AS log_loss"),
        F.expr("sum(pos + neg) AS n"),
        F.expr("sum(pos) AS n_defaults"),
        F.expr(f"array({', '.join(counts(t) for t in thresholds)}) AS at"),
    )
    flat = summary.selectExpr(
        *map(name, by), "roc_auc", "pr_auc", "brier_score", "log_loss", "n", "n_defaults", "inline(at)"
    )
    return with_rates(flat).select(*by, *METRICS)


def metrics(df: DataFrame, threshold: float = 0.5, **kw) -> DataFrame:
    return metric_rows(df, [threshold], **kw)


def business_cost(false_negatives: str, false_positives: str, policy: Policy = POLICY) -> str:
    return (
        f"{number(policy.cost_false_negative)} * {false_negatives} "
        f"+ {number(policy.cost_false_positive)} * {false_positives}"
    )


def cost_at(df: DataFrame, threshold: float, policy: Policy = POLICY, **kw) -> DataFrame:
    return confusion(df, threshold=threshold, **kw).selectExpr(
        f"{number(float(threshold))} AS threshold", f"{business_cost(_FN, _FP, policy)} AS expected_cost"
    )


def class_distribution(df: DataFrame, label: str = "y") -> DataFrame:
    """(label, n, share); the total is a scalar subquery over two rows."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(label, "n", (F.col("n") / total.cast("double")).alias("share"))


def comparison(rows: list[tuple[str, DataFrame]]) -> DataFrame:
    """Stack named one-row metric frames, the 11 quality metrics rounded to 4."""
    named = [frame.select(F.lit(model).alias("model"), "*") for model, frame in rows]
    stacked = reduce(DataFrame.unionByName, named)
    return stacked.withColumns({c: F.bround(c, 4) for c in ROUNDED if c in stacked.columns})
