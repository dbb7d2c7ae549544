"""Row-wise SQL expressions that stay inside whole-stage code generation.

Wide generated projections are written as SQL text: one parsed string costs the
driver far less than thousands of column calls, and Catalyst sees the same tree.
"""

from __future__ import annotations

import math


def number(value: float | int) -> str:
    """A literal; floats as double, since bare decimals would parse as decimal."""
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        raise TypeError(f"not a number: {value!r}")
    if isinstance(value, int):
        return f"({value})"
    if math.isinf(value) or math.isnan(value):
        return f"double('{value}')"
    return f"({value!r}D)"


def text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def hash32(key: str) -> str:
    """First 32 bits of md5 as a bigint: the same number in any SQL engine."""
    return f"cast(conv(substring(md5({key}), 1, 8), 16, 10) AS bigint)"


def seeded_hash(seed: object, column: str) -> str:
    return hash32(f"concat({text(f'{seed}:')}, cast({name(column)} AS string))")


def sum_present(columns) -> str:
    """Row sum over the non-null values; 0 when all are null."""
    return " + ".join(f"coalesce({c}, 0D)" for c in columns)


def count_present(columns) -> str:
    return "(" + " + ".join(f"if({c} IS NULL, 0, 1)" for c in columns) + ")"


def share_of_months(columns, test: str) -> str:
    """Share of the months (nulls included in the denominator) passing a test."""
    hits = " + ".join(f"if({c} {test}, 1, 0)" for c in columns)
    return f"({hits}) / {number(float(len(columns)))}"


def sample_std(columns, mean: str) -> str:
    """Sample standard deviation of the non-null values; 0 below two values."""
    n = count_present(columns)
    squares = " + ".join(f"coalesce(({c} - {mean}) * ({c} - {mean}), 0D)" for c in columns)
    return f"CASE WHEN {n} >= 2 THEN sqrt(try_divide({squares}, cast({n} - 1 AS double))) ELSE 0D END"


def safe_ratio(numerator: str, denominator: str) -> str:
    """n / d, or 0 when d is 0, either side is null, or the result not finite."""
    ratio = f"try_divide({numerator}, {denominator})"
    return f"coalesce(CASE WHEN abs({ratio}) < double('inf') THEN {ratio} END, 0D)"


def ratio_or_zero(numerator: str, denominator: str) -> str:
    """Quotient of counts, 0 for an empty denominator."""
    return f"coalesce(try_divide(cast({numerator} AS double), cast({denominator} AS double)), 0D)"


def clip(value: str, low: str, high: str) -> str:
    """Bound a value; null stays null (``least`` alone would skip it)."""
    return f"CASE WHEN {value} IS NOT NULL THEN least(greatest({value}, {low}), {high}) END"


def bounded(probability: str) -> str:
    return clip(probability, "0D", "1D")


def sigmoid(z: str) -> str:
    return f"1D / (1D + exp(-({z})))"
