"""Pooling by ranges against a plain pooling of all scores and against Spark's own fit."""

import random

import pytest
from pyspark.ml.regression import IsotonicRegression

from arrearscope.operators import calibration as k

SCORES = "p double, pos long, neg long"


def plain_blocks(rows):
    stack = []
    for p, pos, neg in sorted(rows):
        if pos + neg == 0:
            continue
        block = [p, p, pos, pos + neg]
        while stack and stack[-1][2] * block[3] >= block[2] * stack[-1][3]:
            before = stack.pop()
            block = [before[0], block[1], before[2] + block[2], before[3] + block[3]]
        stack.append(block)
    return [tuple(b) for b in stack]


def shapes(n=640):
    rng = random.Random(4)
    yield "noise", [(i / n, rng.randrange(4), rng.randrange(4)) for i in range(n)]
    yield "calibrated", [(i / n, sum(rng.random() < i / n for _ in range(9)), 3) for i in range(n)]
    yield "falling", [(i / n, n - i, i + 1) for i in range(n)]
    yield "rising", [(i / n, i, n - i) for i in range(n)]
    yield "saw", [(i / n, i + (40 if i % 10 == 9 else 0), n) for i in range(n)]
    yield "late fall", [(i / n, i if i < n - 1 else 0, 1 if i < n - 1 else 10 * n * n) for i in range(n)]
    yield "flat", [(i / n, 1, 1) for i in range(n)]
    yield "wide", [(rng.choice([-1e300, 1e300]) * rng.random(), rng.randrange(10**12), 10**12) for _ in range(50)]


@pytest.mark.parametrize(("name", "rows"), list(shapes()), ids=[n for n, _ in shapes()])
def test_blocks_do_not_depend_on_the_ranges(spark, name, rows):
    df = spark.createDataFrame(rows, SCORES)
    want = plain_blocks(rows)
    for ranges in (8, 64) if name != "noise" else (1, 8, 64):
        blocks = k.pooled_blocks(df, scores_per_range=-(-len(rows) // ranges), fan_in=3 if ranges == 8 else 8)
        assert sorted((b.lo, b.hi, b.pos, b.n) for b in blocks.collect()) == want, ranges


def test_no_task_holds_more_ranges_than_said(spark, monkeypatch):
    rows = [(i / 640, i + (40 if i % 10 == 9 else 0), 640) for i in range(640)]
    blocks = k.pooled_blocks(spark.createDataFrame(rows, SCORES), scores_per_range=10)
    sizes = [r["count"] for r in blocks.groupBy("part").count().collect()]
    # blocks stay in the range of their lower end
    assert len(sizes) == 64 and max(sizes) <= 10


def test_predictions_equal_sparks_own_fit(spark):
    rng = random.Random(9)
    rows = [(round(rng.random(), 3), int(rng.random() < 0.3)) for _ in range(3000)]
    rows = [(p, int(y or rng.random() < p / 2)) for p, y in rows]
    df = spark.createDataFrame(rows, "p double, y int")
    own = IsotonicRegression(featuresCol="p", labelCol="y").fit(df)
    asked = spark.createDataFrame([(x / 700 - 0.1,) for x in range(900)], "p double")
    want = {r.p: min(max(r.prediction, 0.0), 1.0) for r in own.setFeaturesCol("p").transform(asked).collect()}
    for ranges in (1, 8, 64):
        fitted = k.fit_isotonic(df, scores_per_range=-(-1001 // ranges))
        found = {r.p: r.q for r in fitted.apply(asked, "p", "q").collect()}
        assert found == pytest.approx(want, abs=1e-12)


def test_few_blocks_reach_the_driver(spark):
    rows = spark.range(300_000).selectExpr("(hash(id) + 2147483648D) / 4294967296D AS p", "hash(id, 1) AS h")
    labelled = rows.selectExpr("p", "if((h + 2147483648D) / 4294967296D < p, 1, 0) AS y")
    blocks = k.pooled_blocks(k.score_counts(labelled, "p", "y"), scores_per_range=20_000)
    assert 10 < blocks.count() < 1000
