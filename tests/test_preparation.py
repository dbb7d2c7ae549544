import numpy as np
import pytest
from pyspark.sql import functions as F

from arrearscope.functions.engineered import engineer
from arrearscope.operators import preparation as p
from arrearscope.roles import FEATURES


def test_fit_equals_the_builtin_percentile(prepared):
    full = engineer(prepared.part("train"))
    fill = p.medians(full, p.SCALED)
    bounds = p.imputed(full, fill)
    for c, scaling in prepared.prep.numeric.items():
        row = full.selectExpr(f"percentile({c}, 0.5D)").first()
        low, high = bounds.selectExpr(f"percentile({c}, array(0.01D, 0.99D))").first()[0]
        assert (scaling.median, scaling.low, scaling.high) == pytest.approx((row[0], low, high))


def test_imputed_ranks_with_many_missing_values(spark):
    for present, missing in (([1.0, 2.0, 10.0], 5), ([4.0], 9), ([1.0, 3.0], 1), (list(map(float, range(50))), 7)):
        df = spark.createDataFrame([(v,) for v in present] + [(None,)] * missing, "x double")
        fill, bounds = p._medians_and_bounds(df, ("x",))
        median = float(np.median(present))
        assert fill["x"] == median
        assert bounds["x"] == pytest.approx(np.quantile(present + [median] * missing, p.WINSOR).tolist())


def test_statistics_come_from_train_only(prepared, clients):
    changed = prepared.table.withColumn(
        "bill_amt1", F.when(F.col("split") == "train", F.col("bill_amt1")).otherwise(F.lit(1e9))
    )
    assert p.fit(changed.filter("split = 'train'")) == prepared.prep


def test_matches_numpy(prepared):
    train = engineer(prepared.part("train")).toPandas()
    out = prepared.prep.transform(prepared.part("train"), keep=("id",)).toPandas().set_index("id")
    train = train.set_index("id").loc[out.index]
    for c in ("bill_amt6", "age", "credit_utilization"):
        x = train[c].astype(float)
        x = x.fillna(x.median())
        x = x.clip(*np.percentile(x, [1, 99]))
        expected = (x - x.mean()) / x.std(ddof=0)
        assert np.allclose(out[f"num__{c}"], expected, atol=1e-9)


def test_winsor_bound_is_a_train_bound(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,), (100.0,)], "x double")
    low, high = p.exact_quantiles(df, ["x"], [0.0, 0.8])["x"]
    probe = spark.createDataFrame([(10_000.0,)], "x double")
    assert p.clipped(probe, {"x": [low, high]}).first()[0] == pytest.approx(22.4)


def test_unknown_and_missing_category(prepared, make_clients):
    out = prepared.prep.transform(make_clients({"education": 99}, {"education": None}), keep=("id",))
    rows = {r.id: r for r in out.collect()}
    hot = [c for c in prepared.prep.names if c.startswith("cat__")]
    assert [rows[1][c] for c in hot] == [0.0] * len(hot)
    mode = prepared.prep.most_frequent["education"]
    assert [rows[2][c] for c in hot] == [1.0 if c == f"cat__education_{mode}" else 0.0 for c in hot]


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([(3,), (3,), (1,), (1,), (2,), (None,)], "education int")
    assert p.most_frequent(df, "education").first()[0] == 1


def test_round_trip_and_names(prepared):
    prep = prepared.prep
    assert p.Preprocessor.from_json(prep.to_json()) == prep
    assert len(prep.names) == 37 + len(prep.levels["education"]) - 1
    assert set(prep.reference) == set(FEATURES)


def test_constant_column_is_not_divided_by_zero(prepared, clients):
    flat = clients.withColumn("age", F.lit(30))
    prep = p.fit(flat)
    assert prep.numeric["age"].std == 1.0
    assert prep.transform(flat).select("num__age").distinct().collect() == [(0.0,)]
