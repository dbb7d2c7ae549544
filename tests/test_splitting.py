import hashlib

import pytest

from arrearscope.functions import quantiles
from arrearscope.operators import splitting as s
from arrearscope.roles import TARGET


def brute_order(ids, seed=42):
    return sorted(ids, key=lambda i: (int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:8], 16), i))


def test_matches_a_full_ranking(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MARKS", 4)
    rows = [(i, int(i % 5 == 0)) for i in range(1, 400)]
    df = spark.createDataFrame(rows, f"id long, {TARGET} int")
    split = {r.id: r.split for r in s.with_split(df).collect()}
    fold = {r.id: r.fold for r in s.with_fold(df, 5).collect()}
    for label in (0, 1):
        order = brute_order([i for i, y in rows if y == label])
        n = len(order)
        for rank, i in enumerate(order, start=1):
            expected = "train" if rank <= s.cut_count(0.70, n) else (
                "validation" if rank <= s.cut_count(0.85, n) else "test"
            )
            assert split[i] == expected
            assert fold[i] == sum(rank > s.cut_count(k / 5, n) for k in range(1, 5))


def test_shares_and_prevalence(prepared, clients):
    n = clients.count()
    total_rate = clients.selectExpr(f"avg({TARGET})").first()[0]
    rows = prepared.table.groupBy("split").agg({"*": "count", TARGET: "avg"}).collect()
    shares = {"train": 0.70, "validation": 0.15, "test": 0.15}
    assert {r["split"] for r in rows} == set(shares)
    for r in rows:
        assert r["count(1)"] / n == pytest.approx(shares[r["split"]], abs=0.02)
        assert r[f"avg({TARGET})"] == pytest.approx(total_rate, abs=0.05)


def test_independent_of_partitioning(clients):
    a = s.with_split(clients).select("id", "split")
    b = s.with_split(clients.repartition(7, "age")).select("id", "split")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    other = s.with_split(clients, seed=7).select("id", "split")
    assert not a.exceptAll(other).isEmpty()


def test_a_repeated_id_stays_on_one_side(spark):
    rows = [(i, 0) for i in range(100)] + [(7, 0)] * 80 + [(i, 1) for i in range(100, 150)]
    df = spark.createDataFrame(rows, f"id long, {TARGET} int")
    sides = s.with_split(df).filter("id = 7").select("split").distinct().count()
    assert sides == 1


def test_fractions_must_sum_to_one(clients):
    with pytest.raises(ValueError, match="sum to 1"):
        s.with_split(clients, {"train": 0.7, "test": 0.2})
