"""Preprocessing fitted on the training rows only.

Numeric columns: median, clip at the 1st and 99th percentile, standardise.
Categorical columns: most frequent value, one-hot without the first level.
``fit`` returns plain numbers; ``transform`` is a projection of literals.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.functions.engineered import ENGINEERED, engineer
from arrearscope.functions.quantiles import (
    as_doubles,
    exact_quantiles,
    extent_of,
    interpolated,
    order_statistics,
    positions,
)
from arrearscope.functions.scalars import clip, name, number
from arrearscope.operators.validation import require_columns
from arrearscope.roles import CATEGORICAL, FEATURES, NUMERIC

WINSOR = (0.01, 0.99)
#: Levels of a categorical column beyond which fitting raises; each level is a model input.
MOST_LEVELS = 1_000
SCALED = (*NUMERIC, *ENGINEERED)


@dataclass(frozen=True)
class Scaling:
    median: float
    low: float
    high: float
    mean: float
    std: float


@dataclass(frozen=True)
class Preprocessor:
    numeric: dict[str, Scaling]
    levels: dict[str, list[int]]
    most_frequent: dict[str, int]
    reference: dict[str, float]

    @property
    def names(self) -> list[str]:
        """Output columns in model order."""
        hot = [f"cat__{c}_{v}" for c, levels in self.levels.items() for v in levels[1:]]
        return [*(f"num__{c}" for c in self.numeric), *hot]

    def standardised(self, column: str) -> str:
        s = self.numeric[column]
        value = f"coalesce(cast({name(column)} AS double), {number(s.median)})"
        # an imputed value is never null, so plain bounds are enough
        bounded = f"least(greatest({value}, {number(s.low)}), {number(s.high)})"
        return f"({bounded} - {number(s.mean)}) / {number(s.std)}"

    def encoded(self) -> dict[str, str]:
        """Model inputs as SQL over an engineered frame."""
        out = {f"num__{c}": self.standardised(c) for c in self.numeric}
        for c, levels in self.levels.items():
            value = f"coalesce({name(c)}, {self.most_frequent[c]})"
            for v in levels[1:]:
                out[f"cat__{c}_{v}"] = f"if({value} = {v}, 1D, 0D)"
        return out

    def encode(self, engineered: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        return engineered.selectExpr(*map(name, keep), *[f"{sql} AS {name(c)}" for c, sql in self.encoded().items()])

    def transform(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """Engineer, impute, clip, scale and encode; other columns are dropped."""
        require_columns(df, FEATURES)
        return self.encode(engineer(df), keep)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Preprocessor:
        raw = json.loads(text)
        return cls(
            {c: Scaling(**s) for c, s in raw["numeric"].items()},
            raw["levels"],
            raw["most_frequent"],
            raw["reference"],
        )


def medians(df: DataFrame, columns) -> dict[str, float]:
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}


def imputed(df: DataFrame, fill: dict[str, float]) -> DataFrame:
    return df.selectExpr(*[f"coalesce(cast({name(c)} AS double), {number(m)}) AS {name(c)}" for c, m in fill.items()])


def winsor_bounds(df: DataFrame, columns) -> dict[str, list[float]]:
    return exact_quantiles(df, columns, list(WINSOR))


def clipped(df: DataFrame, bounds: dict[str, list[float]]) -> DataFrame:
    return df.selectExpr(
        *[
            f"{clip(f'cast({name(c)} AS double)', number(lo), number(hi))} AS {name(c)}"
            for c, (lo, hi) in bounds.items()
        ]
    )


def impute_and_clip(
    df: DataFrame, fill: dict[str, float], bounds: dict[str, tuple[float, float]], keep: tuple[str, ...] = ()
) -> DataFrame:
    """Both steps in one projection, other columns kept by name."""

    def cell(c: str) -> str:
        value = f"coalesce(cast({name(c)} AS double), {number(fill[c])})"
        low, high = bounds[c]
        return f"least(greatest({value}, {number(low)}), {number(high)}) AS {name(c)}"

    return df.selectExpr(*map(name, keep), *map(cell, fill))


def means_and_stds(df: DataFrame, columns) -> DataFrame:
    """Mean and population standard deviation of every column in one row."""
    return df.selectExpr(
        *[f"avg({name(c)}) AS {name(c + '_mean')}" for c in columns],
        *[f"stddev_pop({name(c)}) AS {name(c + '_std')}" for c in columns],
    )


def level_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("int").alias("level"))
        .agg(F.count("*").alias("n"))
    )


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The commonest value, the smallest one on a tie."""
    best = F.max_by("level", F.struct("n", -F.col("level")))
    return level_counts(df, column).agg(best.alias("most_frequent"))


def _medians_and_bounds(full: DataFrame, columns) -> tuple[dict, dict]:
    """Medians and the winsor bounds of the imputed values in one sequence.

    Imputing inserts copies of the median right after the lower middle rank, so
    every rank of the imputed column is either an original rank or the median:
    all of them are looked up together, and the data is scanned half as often.
    """
    sql = as_doubles(columns)
    extent = extent_of(full, sql)
    total = max(r.rows + r.nulls for r in extent.values())
    ranks: dict[str, list[int]] = {}
    for c, r in extent.items():
        middle = positions(r.rows, 0.5)
        edges = [k for q in WINSOR for k in positions(total, q)[:2]]
        ranks[c] = [*middle[:2], *[_original_rank(k, middle[0], total - r.rows) for k in edges]]
        ranks[c] = [k for k in ranks[c] if k is not None]
    stats = order_statistics(full, sql, ranks, extent)
    fill: dict[str, float | None] = {}
    bounds: dict[str, list[float | None]] = {}
    for c, r in extent.items():
        if not r.rows:
            fill[c], bounds[c] = None, [None] * len(WINSOR)
            continue
        low, high, position = positions(r.rows, 0.5)
        fill[c] = interpolated(stats[c][low].value, stats[c][high].value, low, high, position)

        def at(k: int) -> float:
            original = _original_rank(k, low, total - r.rows)
            return fill[c] if original is None else stats[c][original].value

        bounds[c] = []
        for q in WINSOR:
            below, above, place = positions(total, q)
            bounds[c].append(interpolated(at(below), at(above), below, above, place))
    return fill, bounds


def _original_rank(k: int, lower_middle: int, inserted: int) -> int | None:
    """Rank before imputation; None for an inserted median."""
    if k <= lower_middle:
        return k
    return None if k <= lower_middle + inserted else k - inserted


def fit(train: DataFrame) -> Preprocessor:
    """Fit on the given rows: medians and bounds, then moments.

    Every step is a scan of the training rows that returns a few numbers per
    column.
    """
    full = engineer(train)
    columns = (*SCALED, *CATEGORICAL)
    fill, bounds = _medians_and_bounds(full, columns)
    empty = sorted(c for c in SCALED if fill[c] is None)
    if empty:
        raise ValueError(f"no training value in columns {empty}")
    scaled_fill = {c: fill[c] for c in SCALED}
    ready = impute_and_clip(full, scaled_fill, {c: bounds[c] for c in SCALED})
    moments = means_and_stds(ready, SCALED).first()
    numeric = {
        c: Scaling(fill[c], *bounds[c], moments[f"{c}_mean"], moments[f"{c}_std"] or 1.0) for c in SCALED
    }
    levels, modes = {}, {}
    for c in CATEGORICAL:
        found = level_counts(train, c).limit(MOST_LEVELS + 1).collect()
        if len(found) > MOST_LEVELS:
            raise ValueError(f"column {c} has over {MOST_LEVELS} levels; it is no categorical column")
        counts = {r["level"]: r["n"] for r in found}
        levels[c] = sorted(counts)
        modes[c] = max(counts, key=lambda v: (counts[v], -v))
    return Preprocessor(numeric, levels, modes, {c: fill[c] for c in FEATURES})
