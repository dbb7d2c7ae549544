"""Deterministic stratified splits and folds with exact sizes.

Rows are ordered inside each class by (hash of seed and id, id). Instead of
ranking the whole class, which would sort it in one task, the cut points are
found as exact order statistics of the hash, and each row is then placed by
comparing itself with the cuts: a projection without any shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.functions.quantiles import extent_of, order_statistics
from arrearscope.functions.scalars import name, seeded_hash, text
from arrearscope.roles import ROLES, SEED, SPLIT_FRACTIONS

CLASSES = (0, 1)


def check_fractions(fractions) -> None:
    if not math.isclose(sum(fractions), 1.0, abs_tol=1e-8):
        raise ValueError(f"split fractions must sum to 1, got {sum(fractions)}")


def cut_count(fraction: float, rows: int) -> int:
    return math.floor(fraction * rows + 0.5)


def _literal(key) -> str:
    return text(key) if isinstance(key, str) else str(key)


def _cuts(df: DataFrame, h: str, fractions: list[float], id_column: str, target: str):
    """Per class and fraction: the last (hash, id) that falls below the cut.

    Rows of one id share a hash and stay on one side, so a client never appears
    in two splits; with unique ids the sizes are exact.
    """
    t = name(target)
    columns = {str(c): f"CASE WHEN {t} = {c} THEN {h} END" for c in CLASSES}
    extent = extent_of(df, columns)
    wanted = {c: [cut_count(f, r.rows) - 1 for f in fractions] for c, r in extent.items()}
    stats = order_statistics(df, columns, wanted, extent)
    # rows sharing the hash at a cut: one in 2^32 of the table per cut
    shared = {(c, int(s.value)) for c, found in stats.items() for s in found.values() if s.equal > 1}
    ties: dict[tuple[str, int], list] = {}
    if shared:
        hit = " OR ".join(f"({t} = {c} AND {h} = {value})" for c, value in sorted(shared))
        tied = df.filter(hit).groupBy(target, F.expr(h).alias("h"), id_column).agg(F.count("*").alias("n"))
        for r in sorted(tied.collect(), key=lambda r: r[id_column]):
            ties.setdefault((str(r[target]), r["h"]), []).append((r[id_column], r["n"]))
    cuts = {}
    for c, ks in wanted.items():
        for f, k in zip(fractions, ks):
            if k < 0:
                cuts[c, f] = None
                continue
            s = stats[c][k]
            last, seen = None, s.below
            for key, n in ties.get((c, int(s.value)), []):
                last, seen = key, seen + n
                if seen > k:
                    break
            cuts[c, f] = (int(s.value), last)
    return cuts


def _at_or_before(h: str, id_column: str, target: str, cuts, fraction: float) -> str:
    sides = ["false"]
    for c in CLASSES:
        if cuts[str(c), fraction] is None:
            continue
        value, last = cuts[str(c), fraction]
        before = f"{h} <= {value}"
        if last is not None:
            before = f"({h} < {value} OR ({h} = {value} AND {name(id_column)} <= {_literal(last)}))"
        sides.append(f"({name(target)} = {c} AND {before})")
    return "(" + " OR ".join(sides) + ")"


def with_split(
    df: DataFrame,
    fractions: dict[str, float] | None = None,
    seed: int = SEED,
    id_column: str = ROLES.id,
    target: str = ROLES.target,
) -> DataFrame:
    """Append ``split``; shares are exact per class and depend on ids only. Rows without a label have none."""
    fractions = fractions or SPLIT_FRACTIONS
    check_fractions(fractions.values())
    h = seeded_hash(seed, id_column)
    names = list(fractions)
    edges = [sum(list(fractions.values())[: i + 1]) for i in range(len(names) - 1)]
    cuts = _cuts(df, h, edges, id_column, target)
    cases = " ".join(
        f"WHEN {_at_or_before('_h', id_column, target, cuts, e)} THEN {text(part)}" for part, e in zip(names, edges)
    )
    placed = df.selectExpr("*", f"{h} AS _h").selectExpr("*", f"CASE WHEN {name(target)} IS NULL THEN NULL {cases} ELSE {text(names[-1])} END AS split")
    return placed.drop("_h")


def with_fold(
    df: DataFrame,
    folds: int,
    seed: int = SEED,
    id_column: str = ROLES.id,
    target: str = ROLES.target,
) -> DataFrame:
    """Append ``fold`` 0..k-1: equal consecutive blocks of each class's order; null without a label."""
    h = seeded_hash(seed, id_column)
    edges = [(i + 1) / folds for i in range(folds - 1)]
    cuts = _cuts(df, h, edges, id_column, target)
    after = " + ".join(f"if({_at_or_before('_h', id_column, target, cuts, e)}, 0, 1)" for e in edges) or "0"
    return df.selectExpr("*", f"{h} AS _h").selectExpr("*", f"CASE WHEN {name(target)} IS NOT NULL THEN cast({after} AS int) END AS fold").drop("_h")
