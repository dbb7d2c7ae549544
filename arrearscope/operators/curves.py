"""Ranking curves and areas from exact, parallel prefix sums over scores.

Rows are first reduced to one row per distinct score (combined map-side, so a
score shared by a third of all rows is one row), then range-partitioned by score.
Each range is cumulated on its own and shifted by the totals of the ranges above
it; no task ever sorts the whole table, and the driver sees no scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.functions.scalars import name
from arrearscope.session import written


def score_counts(df: DataFrame, score: str, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., p, pos, neg): label counts per distinct score; a missing score has no rank and raises."""
    p = F.col(score).cast("double")
    ranked = F.when(p.isNotNull() & ~F.isnan(p), p).otherwise(F.raise_error(F.lit("a row without a score cannot be ranked")))
    return df.groupBy(*by, ranked.alias("p")).agg(
        F.expr(f"count_if({name(label)} = 1) AS pos"), F.expr(f"count_if({name(label)} = 0) AS neg")
    )


def by_ranges(counts: DataFrame, by: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """``counts`` written in score ranges of about equal size, with the range's number as ``_range``.

    Ranges ascend with the score inside each group. Without a number they are as many as
    the session's shuffle partitions, merged where they are small. Any ranges give the
    same result; they are written because a second cut might fall elsewhere.
    """
    order = [F.col(name(c)) for c in (*by, "p")]
    cut = counts.repartitionByRange(*([ranges] if ranges else []), *order)
    return written(cut.withColumn("_range", F.spark_partition_id()), "scores")


def cols(names) -> str:
    return ", ".join(map(name, names))


def _above(*keys: str) -> list[str]:
    over = f"({f'PARTITION BY {cols(keys)} ' if keys else ''}ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return [f"coalesce(sum({s}) OVER {over}, 0L) AS {s}_above" for s in ("pos", "neg")]


def ranked_counts(
    df: DataFrame,
    score: str = "p",
    label: str = "y",
    by: tuple[str, ...] = (),
    ranges: int | None = None,
) -> DataFrame:
    """One row per distinct score with label counts at and strictly above it.

    Columns: by..., p, pos, neg, pos_above, neg_above. The distinct scores are
    written once, so the scoring behind ``df`` runs a single time although the
    range totals and the prefix sums both read them.
    """
    ranged = by_ranges(score_counts(df, score, label, by), by, ranges)
    # a row per range and group
    totals = ranged.groupBy(*by, "_range").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    part = f"PARTITION BY {cols(by)} " if by else ""
    higher = f"({part}ORDER BY _range DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = totals.selectExpr(
        *map(name, by), "_range", *[f"coalesce(sum({s}) OVER {higher}, 0L) AS {s}_offset" for s in ("pos", "neg")]
    )
    # the join shares its partitioning by range with the window that follows
    placed = ranged.join(offsets, [*by, "_range"]).selectExpr("*", *_above(*by, "_range"))
    return placed.selectExpr(
        *map(name, by), "p", "pos", "neg",
        "pos_offset + pos_above AS pos_above", "neg_offset + neg_above AS neg_above",
    )


# -- aggregates over ranked counts ---------------------------------------------


#: Area under ROC, ties counted half; null if a class is absent.
ROC_AUC = (
    "try_divide(sum(neg * (cast(pos_above AS double) + pos / 2D)), "
    "sum(cast(pos AS double)) * sum(cast(neg AS double)))"
)
#: Step sum of precision over recall gains, not the trapezoid area.
AVERAGE_PRECISION = (
    "try_divide(sum(pos * (cast(pos_above + pos AS double) / (pos_above + pos + neg_above + neg))), "
    "sum(cast(pos AS double)))"
)


def areas(df: DataFrame, score: str = "p", label: str = "y", by: tuple[str, ...] = (), **kw) -> DataFrame:
    ranked = ranked_counts(df, score, label, by, **kw)
    return ranked.groupBy(*by).agg(
        F.expr(f"{ROC_AUC} AS roc_auc"), F.expr(f"{AVERAGE_PRECISION} AS pr_auc")
    )


def _with_totals(ranked: DataFrame) -> DataFrame:
    """Append the numbers of positives and negatives as scalar subqueries."""
    totals = {f"{s}_all": ranked.agg(F.sum(s)).scalar().cast("double") for s in ("pos", "neg")}
    return ranked.withColumns(totals)


def roc_points(df: DataFrame, score: str = "p", label: str = "y", **kw) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, plus the origin (threshold null)."""
    points = _with_totals(ranked_counts(df, score, label, **kw)).selectExpr(
        "p AS threshold",
        "try_divide(cast(neg_above + neg AS double), neg_all) AS fpr",
        "try_divide(cast(pos_above + pos AS double), pos_all) AS tpr",
    )
    origin = df.sparkSession.range(1).selectExpr("cast(NULL AS double) AS threshold", "0D AS fpr", "0D AS tpr")
    return points.unionByName(origin)


def pr_points(df: DataFrame, score: str = "p", label: str = "y", **kw) -> DataFrame:
    """(threshold, precision, recall, prevalence) per distinct score and the end point."""
    ranked = _with_totals(ranked_counts(df, score, label, **kw))
    prevalence = "pos_all / (pos_all + neg_all) AS prevalence"
    points = ranked.selectExpr(
        "p AS threshold",
        "cast(pos_above + pos AS double) / (pos_above + pos + neg_above + neg) AS precision",
        "try_divide(cast(pos_above + pos AS double), pos_all) AS recall",
        prevalence,
    )
    totals = ranked.agg(F.max("pos_all").alias("pos_all"), F.max("neg_all").alias("neg_all"))
    end = totals.selectExpr("cast(NULL AS double) AS threshold", "1D AS precision", "0D AS recall", prevalence)
    return points.unionByName(end)
