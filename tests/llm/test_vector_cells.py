"""Exact search against all products."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrearscope.llm import vector_cells

SCHEMA = "vec_id long, embedding array<double>"


def plain_search(rows, k: int) -> list[tuple]:
    taking = [
        (key, [math.floor(256 * x) for x in v])
        for key, v in rows
        if key is not None and v is not None and all(x is not None and math.isfinite(x) and abs(x) < 2**20 for x in v)
    ]
    out = []
    for query, q in taking:
        if query % 50 == 0:
            others = [(-sum(a * b for a, b in zip(q, v)), key) for key, v in taking if key != query and len(v) == len(q)]
            out += [(query, place, key, -score) for place, (score, key) in enumerate(sorted(others)[:k], start=1)]
    return sorted(out)


def found(df, k: int = 5, **kw) -> list[tuple]:
    return sorted(tuple(r) for r in vector_cells.search(df, df.filter("vec_id % 50 = 0"), k, **kw).collect())


def test_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = plain_search([(r.vec_id, r.embedding) for r in table.collect()], 5)
    assert len(want) == 50
    assert found(table) == want
    assert found(table, slice_rows=60, block_rows=4) == want


def odd_rows(seed: int) -> list[tuple]:
    """Copies, zero vectors, ties, several lengths, broken vectors, repeated ids and rows, no ids."""
    rng = random.Random(seed)
    rows: list[tuple] = []
    for n in range(500):
        v: list | None = [rng.choice([0.0, 0.5, -0.5, rng.random() - 0.5, 1000.25]) for _ in range(rng.choice([4, 4, 4, 2, 0]))]
        if v and rng.random() < 0.1:
            v[0] = rng.choice([None, float("nan"), float("inf"), -float("inf"), 3e6])
        elif rng.random() < 0.4:
            v = rng.choice([[0.25] * 4, [0.25] * 4, [0.0] * 4, None])
        rows.append((rng.choice([None, 50, 100, n, n, n]), v))
    return rows + rows[:30]


@pytest.mark.parametrize(("k", "kw"), [(5, {}), (5, {"slice_rows": 40, "block_rows": 3}), (1, {"slice_rows": 100}), (700, {})])
def test_odd_vectors(spark, k, kw):
    rows = odd_rows(k)
    assert found(spark.createDataFrame(rows, SCHEMA), k, **kw) == plain_search(rows, k)


def test_empty_and_clashing(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5])]
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(table.limit(0)) == [] and found(table.filter("vec_id > 0")) == []
    names = ("id", "v", "entry", "query", "dim", "slice", "block", "score", "rank", "ids")
    assert found(table.select("*", *[F.lit(1).alias(c) for c in names])) == found(table) == [(0, 1, 1, 65536), (0, 2, 2, 32768)]
    with pytest.raises(ValueError, match="embedding"):
        vector_cells.search(table.drop("embedding"), table, 5)


def test_cells_bound_every_product():
    rng = np.random.default_rng(0)
    v = rng.integers(-300, 300, (1000, 12)).astype(np.int32)
    v[:, 3] = 7
    v[::5, 4] = 100_000_000
    codes, low, high = vector_cells.cells_of(v)
    columns = np.arange(12)
    assert (low[columns, codes] <= v).all() and (v <= high[columns, codes]).all()
    q = rng.integers(-300, 300, (40, 12)).astype(np.int32)
    least, most = vector_cells.bounds(q, codes, low, high)
    exact = q.astype(np.int64) @ v.T.astype(np.int64)
    assert (least <= exact).all() and (exact <= most).all()
    # borders of equal values are exact
    assert (low[3, codes[:, 3]] == high[3, codes[:, 3]]).all()


def test_copies_are_one_entry(spark):
    rows = [(i, [0.5, 0.25]) for i in range(3000)] + [(5000, [0.1, 0.1])]
    base = vector_cells.vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", 256)
    kept = {tuple(r.v): [i.id for i in r.ids] for r in vector_cells.entries(base, 5).collect()}
    assert kept == {(128, 64): [0, 1, 2, 3, 4, 5], (25, 25): [5000]}
