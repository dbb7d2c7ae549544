"""Codebook cleaning and role projections."""

from __future__ import annotations

from pyspark.sql import DataFrame

from arrearscope.roles import CODEBOOK, ROLES, Roles

# The catch-all code per column; None leaves the value missing.
OTHER_CODE = {"education": 4, "marriage": 3, "sex": None}


def _cleaned(df: DataFrame, column: str) -> str:
    if column not in OTHER_CODE:
        return f"`{column}`"
    codes = ", ".join(map(str, CODEBOOK[column]))
    other = "NULL" if OTHER_CODE[column] is None else OTHER_CODE[column]
    kind = df.schema[column].dataType.simpleString()
    return f"CASE WHEN {column} IN ({codes}) THEN {column} ELSE cast({other} AS {kind}) END AS {column}"


def clean(df: DataFrame) -> DataFrame:
    """Out-of-codebook or missing codes become the catch-all code (sex: null).

    Columns the frame lacks are skipped, so a scoring batch without the
    sensitive columns goes through the same function.
    """
    return df.selectExpr(*[_cleaned(df, c) for c in df.columns])


def features_and_target(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Model inputs and label only: ids and sensitive columns cannot leak."""
    return df.select(*roles.features, roles.target)


def covariates(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Audit-only columns: the id and those sensitive columns that exist."""
    return df.select(*[c for c in (roles.id, *roles.sensitive) if c in df.columns])
