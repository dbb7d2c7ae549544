"""Exact order statistics and quantiles for many columns at once, at any size.

``percentile`` is exact but merges every distinct value of a column into one
task. Here one scan counts every column and sketches it: the sketch is mergeable,
its size is fixed, and it tells for every rank two values that enclose it. A second
scan counts what lies below, between and above those brackets, all of it combined
map-side, and lists the distinct values inside, a few thousandths of the rows per
rank; these are put in order by ranges and cumulated range by range. So two scans
find any number of ranks of any number of columns, and only the wanted values reach
the driver. The counts are exact, so the result is: a rank that a sketch missed is
seen to lie outside its bracket, and that part of the column is opened again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.functions.scalars import name, number
from arrearscope.session import tidy, written

#: Steps between the marks of a sketch; its rank error is half a step at most.
MARKS = 500


@dataclass(frozen=True)
class OrderStatistic:
    """Value at a 0-based rank, with the rows strictly below and equal to it."""

    value: float
    below: int
    equal: int


@dataclass(frozen=True)
class Extent:
    """Rows with a value, the smallest and largest value, marks at equal steps of the ranks, rows without a value."""

    low: float | None
    high: float | None
    rows: int
    marks: tuple[float, ...]
    nulls: int = 0

    def bracket(self, rank: int) -> tuple[float, float]:
        """Two values that enclose a rank if the sketch keeps its promise."""
        steps = len(self.marks) - 1
        place = rank / max(self.rows - 1, 1) * steps
        first, last = math.floor(place) - 1, math.ceil(place) + 1
        return self.marks[first] if first > 0 else self.low, self.marks[last] if last < steps else self.high


def extent_of(df: DataFrame, columns: dict[str, str]) -> dict[str, Extent]:
    """Count, ends and sketch of every expression in one aggregate; nulls are no values."""
    # one literal instead of hundreds keeps the plan of many columns small
    levels = f"cast(split('{' '.join(str(i / MARKS) for i in range(MARKS + 1))}', ' ') AS array<double>)"
    aggs = []
    for i, sql in enumerate(columns.values()):
        value = f"cast({sql} AS double)"
        marks = f"percentile_approx({value}, {levels}, {2 * MARKS})"
        aggs.append(f"named_struct('n', count({value}), 'all', count(*), 'lo', min({value}), 'hi', max({value}), 'marks', {marks}) AS x{i}")
    row = df.selectExpr(*aggs).first()
    return {c: Extent(r["lo"], r["hi"], r["n"], tuple(r["marks"] or ()), r["all"] - r["n"]) for c, r in zip(columns, row)}


def _joined(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Disjoint brackets in order."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(brackets):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _cell(value: str, brackets: list[tuple[float, float]]) -> str:
    """Odd numbers for values inside the brackets, even ones between and beyond."""
    cases = []
    for i, (low, high) in enumerate(brackets):
        cases.append(f"WHEN {value} < {number(float(low))} THEN {2 * i} WHEN {value} <= {number(float(high))} THEN {2 * i + 1}")
    return f"CASE {' '.join(cases)} ELSE {2 * len(brackets)} END"


def _counted(df: DataFrame, columns: dict[str, str], brackets: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """(j, cell, value, n): distinct values inside brackets, and one row per cell outside."""
    entries = []
    for j, c in enumerate(columns):
        if brackets.get(c):
            value = f"cast({columns[c]} AS double)"
            cell = f"if({value} IS NULL, NULL, {_cell(value, brackets[c])})"
            entries.append(f"named_struct('j', {j}, 'cell', {cell}, 'value', {value})")
    rows = df.selectExpr(f"inline(array({', '.join(entries)}))").filter("cell IS NOT NULL")
    inside = F.expr("if(cell % 2 = 1, value, NULL)").alias("value")
    return rows.groupBy("j", "cell", inside).agg(F.count("*").alias("n"))


def _at_ranks(counts: DataFrame, wanted: list[tuple[int, int]]) -> list:
    """Rows (j, k, cell, value, below, n) of the values at the wanted ranks k of column j."""
    order = ["cell", "value"]
    ranged = counts.repartitionByRange("j", *order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "ranks")
    starts, held = {}, dict.fromkeys((j for j, _ in wanted), 0)
    # a row per range and column
    for r in sorted(ranged.groupBy("j", "part").agg(F.sum("n").alias("rows")).collect()):
        starts[r["j"], r["part"]] = held[r["j"]]
        held[r["j"]] += r["rows"]
    # only the ranges that hold a wanted rank are read again
    sought = []
    for j, k in wanted:
        parts = [(start, part) for (column, part), start in starts.items() if column == j and start <= k]
        if parts:
            start, part = max(parts)
            sought.append((j, part, k, start))
    if not sought:
        return []
    ranks = counts.sparkSession.createDataFrame(sought, "j int, part int, k bigint, start bigint")
    upto = F.sum("n").over(Window.partitionBy("part", "j").orderBy(*order)) - F.col("n")
    placed = ranged.filter(F.col("part").isin({part for _, part, _, _ in sought})).withColumn("before", upto)
    found = placed.join(F.broadcast(ranks), ["j", "part"]).withColumn("below", F.col("start") + F.col("before"))
    return found.filter("k >= below AND k < below + n").collect()


def order_statistics(
    df: DataFrame,
    columns: dict[str, str],
    ranks: dict[str, list[int]],
    extent: dict[str, Extent] | None = None,
) -> dict[str, dict[int, OrderStatistic]]:
    """Exact values at 0-based ranks of the non-null values of each expression.

    Ranks outside a column's row count are left out of the result. NaN has no place
    in the order and raises; infinite values are ordinary ends. One way at every size.
    """
    extent = extent or extent_of(df, columns)
    if unordered := [c for c, r in extent.items() if r.rows and math.isnan(r.high)]:
        raise ValueError(f"NaN in columns {unordered}")
    names = list(columns)
    done: dict[str, dict[int, OrderStatistic]] = {c: {} for c in columns}
    open_ranks = {c: sorted({k for k in ranks[c] if 0 <= k < extent[c].rows}) for c in columns}
    brackets = {c: _joined([extent[c].bracket(k) for k in ks]) for c, ks in open_ranks.items() if ks}
    while brackets:
        wanted = [(names.index(c), k) for c in brackets for k in open_ranks[c]]
        missed: dict[str, list[tuple[float, float]]] = {}
        with tidy(df.sparkSession):
            found = _at_ranks(_counted(df, columns, brackets), wanted)
        for r in found:
            c = names[r["j"]]
            if r["value"] is not None:
                done[c][r["k"]] = OrderStatistic(r["value"], r["below"], r["n"])
                continue
            # between two brackets, or beyond one: that part of the column comes next
            left, right = r["cell"] // 2 - 1, r["cell"] // 2
            low = brackets[c][left][1] if left >= 0 else extent[c].low
            high = brackets[c][right][0] if right < len(brackets[c]) else extent[c].high
            missed.setdefault(c, []).append((low, high))
        if len(found) < len(wanted):
            raise ArithmeticError("no value at some ranks; the rows changed between two scans")
        open_ranks = {c: [k for k in ks if k not in done[c]] for c, ks in open_ranks.items()}
        brackets = {c: _joined(b) for c, b in missed.items()}
    return done


def positions(n: int, q: float) -> tuple[int, int, float]:
    """Ranks on both sides of a quantile of n values, and its exact position."""
    position = (n - 1) * q
    return math.floor(position), math.ceil(position), position


def interpolated(a: float, b: float, low: int, high: int, position: float) -> float:
    return a if a == b else (high - position) * a + (position - low) * b


def as_doubles(columns) -> dict[str, str]:
    """Column names, or names mapped to SQL, as SQL over doubles."""
    if not isinstance(columns, dict):
        columns = {c: name(c) for c in columns}
    return {c: f"cast({sql} AS double)" for c, sql in columns.items()}


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, str] | list[str] | tuple[str, ...],
    quantiles: list[float],
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column, nulls skipped.

    ``columns`` names columns, or maps names to SQL expressions. Equal to
    ``percentile``; an empty column gives None.
    """
    sql = as_doubles(columns)
    extent = extent_of(df, sql)
    ranks = {c: [k for q in quantiles for k in positions(r.rows, q)[:2]] for c, r in extent.items()}
    stats = order_statistics(df, sql, ranks, extent)

    def value(c: str, q: float) -> float | None:
        if not extent[c].rows:
            return None
        low, high, position = positions(extent[c].rows, q)
        return interpolated(stats[c][low].value, stats[c][high].value, low, high, position)

    return {c: [value(c, q) for q in quantiles] for c in columns}
