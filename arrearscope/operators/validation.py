"""Data-quality checks: structural errors, one-row report, row quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrearscope.functions.scalars import name, text
from arrearscope.roles import CODEBOOK, DEFAULT_RATE_BAND, FIELD_RANGES, ROLES, Roles


class DataValidationError(ValueError):
    """The table breaks a structural rule."""


# -- plan-time checks (no job) -------------------------------------------------


def require_columns(df: DataFrame, columns) -> None:
    absent = sorted(set(columns) - set(df.columns))
    if absent:
        raise DataValidationError(f"required columns are missing: {absent}")


def forbid_columns(df: DataFrame, allowed) -> None:
    unknown = sorted(set(df.columns) - set(allowed))
    if unknown:
        raise DataValidationError(f"unexpected columns: {unknown}")


# -- aggregates ----------------------------------------------------------------


def _is_missing(df: DataFrame, column: str) -> str:
    c = name(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return f"({c} IS NULL OR isnan({c}))"
    return f"({c} IS NULL)"


def missing_by_column(df: DataFrame) -> DataFrame:
    """(column_name, n_missing) for columns with at least one missing value.

    One aggregate row for all columns, turned long afterwards.
    """
    counts = df.selectExpr(*[f"count_if({_is_missing(df, c)}) AS {name(c)}" for c in df.columns])
    return counts.unpivot([], list(df.columns), "column_name", "n_missing").filter("n_missing > 0")


def missing_total(df: DataFrame) -> DataFrame:
    counts = missing_by_column(df)
    return counts.agg(
        F.coalesce(F.sum("n_missing"), F.lit(0)).cast("bigint").alias("n_missing"),
        F.count("*").alias("n_columns_with_missing"),
    )


def invalid_targets(df: DataFrame, target: str = ROLES.target) -> DataFrame:
    """Number of non-null labels outside {0, 1}."""
    return df.agg(F.count_if(~F.col(target).isin(0, 1)).alias("n_invalid"))


def _extra_copies(counts: DataFrame, alias: str) -> DataFrame:
    return counts.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias(alias))


def duplicate_ids(df: DataFrame, id_column: str = ROLES.id) -> DataFrame:
    """Rows beyond the first of each id; missing ids form one group."""
    return _extra_copies(df.groupBy(id_column).agg(F.count("*").alias("copies")), "n_duplicate_ids")


def row_counts(df: DataFrame) -> DataFrame:
    """(h1, h2, copies): rows counted by 128 bits of hash over all their values.

    A null is told from every value, and null equals null. Equal rows are counted
    map-side and different rows spread evenly, whatever ids they share.
    """
    parts = [part for c in df.columns for part in (F.col(name(c)).isNull(), F.col(name(c)))]
    hashes = [F.xxhash64(F.lit(seed), *parts).alias(f"h{seed}") for seed in (1, 2)]
    return df.select(*hashes).groupBy("h1", "h2").agg(F.count("*").alias("copies"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows, null equal to null."""
    return _extra_copies(row_counts(df), "n_duplicate_rows")


def out_of_codebook(df: DataFrame, codebook: dict[str, tuple[int, ...]] | None = None) -> DataFrame:
    """(attribute, code, n) of codes the codebook lacks; nulls are not counted."""
    codebook = {c: v for c, v in (codebook or CODEBOOK).items() if c in df.columns}
    codes = df.select(*[F.col(c).cast("int").alias(c) for c in codebook])
    unexpected = F.lit(False)
    for column, valid in codebook.items():
        unexpected = unexpected | ((F.col("attribute") == column) & ~F.col("code").isin(*valid))
    return (
        codes.unpivot([], list(codebook), "attribute", "code")
        .filter(F.col("code").isNotNull() & unexpected)
        .groupBy("attribute", "code")
        .agg(F.count("*").alias("n"))
    )


def default_rate(df: DataFrame, target: str = ROLES.target) -> DataFrame:
    return df.agg(
        F.sum(target).cast("bigint").alias("n_defaults"), F.avg(target).alias("default_rate")
    )


def quality_report(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """All checks as one row; nested maps for missing and unexpected codes.

    One scan feeds all plain and missing-value counts; duplicates and codes come
    in as scalar subqueries that read only the columns they need.
    """
    require_columns(df, roles.ordered)
    per_attribute = (
        out_of_codebook(df)
        .groupBy("attribute")
        .agg(
            F.map_from_entries(
                F.sort_array(F.collect_list(F.struct(F.col("code").cast("string").alias("code"), "n")))
            ).alias("codes")
        )
    )
    codes = per_attribute.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("attribute", F.map_entries("codes").alias("codes"))))).alias("m")
    )
    t = name(roles.target)
    counts = df.selectExpr(
        "count(*) AS n_rows",
        f"count_if({t} NOT IN (0, 1)) AS n_invalid_targets",
        f"cast(sum({t}) AS bigint) AS n_defaults",
        f"bround(avg({t}), 6) AS default_rate",
        f"map({', '.join(f'{text(c)}, count_if({_is_missing(df, c)})' for c in df.columns)}) AS missing",
    )
    flat = counts.select(
        "*",
        duplicate_rows(df).scalar().alias("n_duplicate_rows"),
        duplicate_ids(df, roles.id).scalar().alias("n_duplicate_ids"),
        codes.scalar().alias("codes"),
    )
    return flat.selectExpr(
        "n_rows",
        f"{len(df.columns)}L AS n_columns",
        f"{len(roles.features)}L AS n_features",
        "aggregate(map_values(missing), 0L, (a, n) -> a + n) AS n_missing",
        "map_filter(missing, (c, n) -> n > 0) AS missing_by_column",
        "n_duplicate_rows",
        "n_duplicate_ids",
        "n_invalid_targets",
        "n_defaults",
        "default_rate",
        "transform_values(codes, (a, found) -> map_from_entries(found)) AS out_of_codebook",
    )


def check(
    df: DataFrame,
    strict_prevalence: bool = True,
    expected_rows: int | None = None,
    expected_columns: int | None = None,
    roles: Roles = ROLES,
) -> DataFrame:
    """Raise on a structural violation, else return the report row."""
    require_columns(df, roles.ordered)
    if expected_columns is not None and len(df.columns) != expected_columns:
        raise DataValidationError(f"{len(df.columns)} columns, expected {expected_columns}")
    target = F.col(roles.target)
    row = df.agg(
        F.count("*").alias("n"),
        F.count_if(~target.isin(0, 1)).alias("invalid"),
        F.avg(target).alias("rate"),
    ).first()
    if row["invalid"]:
        raise DataValidationError(f"{row['invalid']} labels are not 0 or 1")
    if expected_rows is not None and row["n"] != expected_rows:
        raise DataValidationError(f"{row['n']} rows, expected {expected_rows}")
    low, high = DEFAULT_RATE_BAND
    if strict_prevalence and not (row["rate"] is not None and low <= row["rate"] <= high):
        raise DataValidationError(f"default rate {row['rate']} is outside [{low}, {high}]")
    return quality_report(df, roles)


# -- scoring batches -----------------------------------------------------------


def all_features_missing(df: DataFrame, roles: Roles = ROLES) -> str:
    return " AND ".join(_is_missing(df, c) for c in roles.features)


def scoring_batch_report(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    require_columns(df, roles.features)
    return df.selectExpr(
        "count(*) AS n_rows", f"count_if({all_features_missing(df, roles)}) AS n_all_missing"
    )


def check_scoring_batch(df: DataFrame, roles: Roles = ROLES) -> None:
    row = scoring_batch_report(df, roles).first()
    if not row["n_rows"]:
        raise DataValidationError("the scoring batch is empty")
    if row["n_all_missing"]:
        raise DataValidationError(f"{row['n_all_missing']} rows have no feature at all")


def _violation(column: str, low, high) -> str:
    c = name(column)
    found = [f"WHEN {c} IS NULL OR isnan({c}) THEN {text(column + ':missing')}"]
    if low is not None:
        found.append(f"WHEN {c} < {low} THEN {text(f'{column}:below {low}')}")
    if high is not None:
        found.append(f"WHEN {c} > {high} THEN {text(f'{column}:above {high}')}")
    return f"CASE {' '.join(found)} END"


def with_rejections(df: DataFrame, ranges: dict | None = None) -> DataFrame:
    """Append ``rejections``: the broken field rules of each row, [] if none."""
    ranges = ranges or FIELD_RANGES
    require_columns(df, ranges)
    broken = ", ".join(_violation(c, low, high) for c, (low, high) in ranges.items())
    return df.selectExpr("*", f"array_compact(array({broken})) AS rejections")


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with reasons)."""
    marked = with_rejections(df)
    return (
        marked.filter(F.size("rejections") == 0).drop("rejections"),
        marked.filter(F.size("rejections") > 0),
    )
