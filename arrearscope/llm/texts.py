"""Expressions over texts that several operators share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space: blank, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; pure ASCII texts take the fast built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def split_words(text: Column, separators: str = SPACE) -> Column:
    """Non-empty pieces between runs of separators; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def need(docs: DataFrame, *columns: str) -> None:
    absent = [c for c in columns if c not in docs.columns]
    if absent:
        raise ValueError(f"columns not in the table: {', '.join(absent)}")


def without(columns: list[str], *added: str) -> list[str]:
    """``columns`` but those that clash with columns an operator adds; these give way."""
    taken = {a.lower() for a in added}
    return [c for c in columns if c.lower() not in taken]


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
