"""Outcome audit by group at a frozen threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.functions.bands import age_band, group_label
from arrearscope.functions.scalars import name, number, ratio_or_zero, text
from arrearscope.roles import ROLES, Roles

# Audited spreads.
DISPARITY_METRICS = ("recall", "false_positive_rate", "false_negative_rate", "selection_rate")


def _rates(keys) -> list[str]:
    return [
        *map(name, keys),
        "n",
        "tp + fn AS n_defaults",
        f"{ratio_or_zero('tp + fn', 'n')} AS base_rate",
        f"{ratio_or_zero('tp + fp', 'n')} AS selection_rate",
        f"{ratio_or_zero('tp', 'tp + fp')} AS precision",
        f"{ratio_or_zero('tp', 'tp + fn')} AS recall",
        f"{ratio_or_zero('fp', 'fp + tn')} AS false_positive_rate",
        f"{ratio_or_zero('fn', 'fn + tp')} AS false_negative_rate",
    ]


def _counts(flag: str, y: str, n: str = "1L") -> list:
    """Row count and the four confusion counts over pre-counted rows."""
    sides = {"tp": f"{flag} AND {y}", "fp": f"{flag} AND NOT {y}", "fn": f"NOT {flag} AND {y}", "tn": f"NOT {flag} AND NOT {y}"}
    return [
        F.expr(f"sum({n}) AS n"),
        *[F.expr(f"sum(if({test}, {n}, 0L)) AS {c}") for c, test in sides.items()],
    ]


def group_metrics(
    df: DataFrame, threshold: float, group: str | tuple[str, ...] = "grp", score: str = "p", label: str = "y"
) -> DataFrame:
    """Counts and rates per group: one map-side combined aggregate."""
    keys = (group,) if isinstance(group, str) else tuple(group)
    flag = f"({name(score)} >= {number(float(threshold))})"
    return df.groupBy(*keys).agg(*_counts(flag, f"({name(label)} = 1)")).selectExpr(*_rates(keys))


def audit(
    df: DataFrame, threshold: float, score: str = "p", label: str = "y", roles: Roles = ROLES
) -> DataFrame:
    """Group metrics of every sensitive attribute and the age band in one pass.

    Rows are reduced to (attribute values, score side, label) counts before they
    are fanned out per attribute, so the fan-out works on a few hundred rows.
    """
    attributes = {c: group_label(c) for c in roles.sensitive if c in df.columns}
    if "age" in df.columns:
        attributes["age_band"] = age_band("age")
    flagged = (F.col(score) >= F.lit(threshold)).cast("int")
    cells = (
        df.select(*[F.expr(v).alias(c) for c, v in attributes.items()], flagged.alias("_flag"), F.col(label).alias("_y"))
        .groupBy(*attributes, "_flag", "_y")
        .agg(F.count("*").alias("_n"))
    )
    pairs = ", ".join(f"named_struct('attribute', {text(c)}, 'group', {name(c)})" for c in attributes)
    long = cells.selectExpr("_flag = 1 AS _flag", "_y = 1 AS _y", "_n", f"inline(array({pairs}))")
    counted = long.groupBy("attribute", "group").agg(*_counts("_flag", "_y", "_n"))
    return counted.selectExpr(*_rates(("attribute", "group")))


def disparity(audited: DataFrame) -> DataFrame:
    """Min, max and spread of each audited rate per attribute."""
    return (
        audited.unpivot(["attribute"], list(DISPARITY_METRICS), "metric", "value")
        .groupBy("attribute", "metric")
        .agg(
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            (F.max("value") - F.min("value")).alias("spread"),
        )
    )
