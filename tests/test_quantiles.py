import numpy as np
import pytest

from arrearscope.functions import quantiles as q

LEVELS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


@pytest.fixture(params=[4, 500])
def few_marks(request, monkeypatch):
    """Wide and narrow brackets on small data."""
    monkeypatch.setattr(q, "MARKS", request.param)


def columns():
    rng = np.random.default_rng(3)
    n = 3000
    hot = np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n))
    return {
        "plain": rng.normal(size=n),
        "skewed": np.exp(rng.normal(scale=6, size=n)),
        "hot": hot,
        "constant": np.full(n, 7.0),
        "grid": rng.integers(0, 5, n).astype(float),
    }


def test_exact_on_every_shape(spark, few_marks):
    data = columns()
    df = spark.createDataFrame(list(zip(*[map(float, v) for v in data.values()])), list(data))
    found = q.exact_quantiles(df, list(data), LEVELS)
    for c, values in data.items():
        assert found[c] == pytest.approx(np.quantile(values, LEVELS).tolist(), rel=1e-12, abs=1e-12), c
    levels = ", ".join(f"{x}D" for x in LEVELS)
    builtin = df.selectExpr(*[f"percentile({c}, array({levels})) AS {c}" for c in data]).first()
    for c in data:
        assert found[c] == pytest.approx(builtin[c], rel=1e-12, abs=1e-12)


def test_nulls_are_skipped_and_empty_columns_give_none(spark, few_marks):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (2.0, None)], "a double, b double")
    assert q.exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [2.0], "b": [None]}


def test_order_statistics_count_ties(spark, few_marks):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 1, 1, 2, 2, 9, 9, 9, 9]], "x double")
    stats = q.order_statistics(df, {"x": "x"}, {"x": [0, 3, 5, 9, 10]})["x"]
    assert stats[0] == q.OrderStatistic(1.0, 0, 3)
    assert stats[3] == q.OrderStatistic(2.0, 3, 2)
    assert stats[5] == q.OrderStatistic(5.0, 5, 1)
    assert stats[9] == q.OrderStatistic(9.0, 6, 4)
    assert 10 not in stats


def test_infinite_and_huge_values_end(spark, few_marks):
    values = [float("-inf"), -1.7e308, -1.0, 0.0, 1.0, 2.0, 1.7e308, float("inf")] * 4
    df = spark.createDataFrame([(v,) for v in values], "x double")
    stats = q.order_statistics(df, {"x": "x"}, {"x": list(range(len(values)))})["x"]
    assert [stats[k].value for k in range(len(values))] == sorted(values)


def test_nan_is_refused(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    with pytest.raises(ValueError, match="NaN"):
        q.exact_quantiles(df, ["x"], [0.5])


def test_a_misleading_sketch_costs_a_scan_and_no_rank(spark, monkeypatch):
    values = [float(v % 97) for v in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    extent = {"x": q.Extent(0.0, 96.0, 1000, tuple([0.0, *[90.0] * 499, 96.0]))}
    scans = []
    counted = q._counted
    monkeypatch.setattr(q, "_counted", lambda *a: scans.append(1) or counted(*a))
    stats = q.order_statistics(df, {"x": "x"}, {"x": [400, 500, 999]}, extent)["x"]
    assert [stats[k].value for k in (400, 500, 999)] == [sorted(values)[k] for k in (400, 500, 999)]
    assert len(scans) == 2


def test_two_scans_for_all_columns_and_ranks(spark, monkeypatch):
    data = columns()
    df = spark.createDataFrame(list(zip(*[map(float, v) for v in data.values()])), list(data)).repartition(7)
    seen = []
    monkeypatch.setattr(q, "extent_of", lambda *a, f=q.extent_of: seen.append("sketch") or f(*a))
    monkeypatch.setattr(q, "_counted", lambda *a, f=q._counted: seen.append("count") or f(*a))
    q.exact_quantiles(df, list(data), LEVELS)
    assert seen == ["sketch", "count"]


def test_brackets_list_few_values(spark):
    df = spark.range(200_000).selectExpr("cast(hash(id) AS double) AS x", "cast(id % 3 AS double) AS y")
    columns = {"x": "x", "y": "y"}
    extent = q.extent_of(df, columns)
    assert [extent[c].rows for c in columns] == [200_000, 200_000]
    brackets = {c: [extent[c].bracket(100_000)] for c in columns}
    counts = q._counted(df, columns, brackets)
    rows = {r["j"]: r["n"] for r in counts.groupBy("j").count().withColumnRenamed("count", "n").collect()}
    # a rank's bracket is about four steps wide
    assert rows[0] < 6 * 200_000 / q.MARKS and rows[1] <= 3
    assert counts.agg({"n": "sum"}).first()[0] == 400_000


def test_ranges_do_not_change_the_result(spark):
    data = columns()
    df = spark.createDataFrame([(float(v),) for v in data["hot"]], "x double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for parts in ("1", "5", "31"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found.append(q.exact_quantiles(df, ["x"], LEVELS))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
