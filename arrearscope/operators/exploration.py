"""Descriptive queries over the client table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.functions.engineered import engineer
from arrearscope.functions.quantiles import exact_quantiles
from arrearscope.functions.scalars import clip, name, number, text
from arrearscope.operators.cleaning import clean
from arrearscope.roles import ROLES

# Columns of the descriptive reports.
DESCRIBED = ("limit_bal", "age", "bill_amt1", "pay_amt1")
CONTRASTED = ("payment_delay_rate", "max_delay_months", "credit_utilization", "payment_to_bill_ratio")
RATED = ("sex", "education", "marriage")
HISTOGRAM_BINS = 40


def target_counts(df: DataFrame, target: str = ROLES.target) -> DataFrame:
    return df.groupBy(target).agg(F.count("*").alias("n")).orderBy(target)


def default_rate_by_attribute(df: DataFrame, target: str = ROLES.target) -> DataFrame:
    """Default rate per (attribute, code); a missing code is left out."""
    cells = df.groupBy(*RATED).agg(F.sum(target).alias("_pos"), F.count(target).alias("_n"))
    return (
        cells.unpivot(["_pos", "_n"], list(RATED), "attribute", "code")
        .filter(F.col("code").isNotNull())
        .groupBy("attribute", "code")
        .agg((F.sum("_pos") / F.sum("_n").cast("double")).alias("default_rate"))
    )


def describe(df: DataFrame, columns: tuple[str, ...] = DESCRIBED) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max, one row per column."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                *[F.lit(q).cast("double").alias(name) for name, q in zip(("q25", "q50", "q75"), quartiles[c])],
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return wide.select(F.inline(F.array(*columns)))


def histograms(df: DataFrame, columns: tuple[str, ...] = DESCRIBED, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width counts after clipping at the 1st and 99th percentile.

    The last bin is closed on the right; empty bins are not listed.
    """
    bounds = exact_quantiles(df, columns, [0.01, 0.99])
    cells = []
    for c, (low, high) in bounds.items():
        value = clip(f"cast({name(c)} AS double)", number(low), number(high))
        width = number((high - low) / bins if high > low else 1.0)
        # least() would turn a missing value into the last bin
        slot = f"if({name(c)} IS NULL, NULL, cast(least(floor(({value} - {number(low)}) / {width}), {bins - 1}) AS int))"
        cells.append(f"named_struct('column_name', {text(c)}, 'bin', {slot})")
    return (
        df.selectExpr(f"inline(array({', '.join(cells)}))")
        .filter("bin IS NOT NULL")
        .groupBy("column_name", "bin")
        .agg(F.count("*").alias("n"))
    )


def engineered_means_by_target(df: DataFrame, target: str = ROLES.target) -> DataFrame:
    """Mean of four engineered features per class of the cleaned table."""
    return engineer(clean(df)).groupBy(target).agg(*[F.avg(c).alias(c) for c in CONTRASTED])


def schema_listing(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes
