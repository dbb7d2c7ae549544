import numpy as np
import pytest

from arrearscope.operators import curves, groups, metrics, thresholds
from arrearscope.roles import POLICY
from arrearscope.sources.statements import scored

from conftest import SMALL


def frame(spark, y, p, g=None):
    g = g or ["a"] * len(y)
    return spark.createDataFrame([(int(a), float(b), c) for a, b, c in zip(y, p, g)], "y int, p double, grp string")


def brute(y, p):
    y, p = np.asarray(y), np.asarray(p)
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ap, recall = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        flagged = p >= t
        r = (y[flagged] == 1).sum() / len(pos)
        ap += (r - recall) * (y[flagged] == 1).mean()
        recall = r
    return auc, ap


@pytest.mark.parametrize("ranges", [None, 1, 60])
@pytest.mark.parametrize("decimals", [1, 6])
def test_areas_against_brute_force(spark, ranges, decimals):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 300)
    p = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), decimals)
    row = curves.areas(frame(spark, y, p), ranges=ranges).first()
    assert (row.roc_auc, row.pr_auc) == pytest.approx(brute(y, p))


def test_clustered_scores_and_groups(spark):
    """Nearly all scores in a tiny interval, one score held by a third of rows."""
    rng = np.random.default_rng(6)
    n = 400
    y = rng.integers(0, 2, n)
    p = np.where(rng.random(n) < 0.33, 0.5, 1e-6 * rng.random(n) + 1e-7 * y)
    g = ["a" if v else "b" for v in rng.integers(0, 2, n)]
    rows = curves.areas(frame(spark, y, p, g), by=("grp",), ranges=40).collect()
    for r in rows:
        keep = [i for i in range(n) if g[i] == r.grp]
        assert (r.roc_auc, r.pr_auc) == pytest.approx(brute(y[keep], p[keep]))


def test_perfect_scores(spark):
    row = metrics.metrics(frame(spark, [0, 0, 1, 1], [0.01, 0.02, 0.98, 0.99])).first()
    assert row.roc_auc == row.pr_auc == row.precision == row.recall == 1.0
    assert row.brier_score < 0.01


def test_equality_counts_as_positive(spark):
    row = metrics.metrics(frame(spark, [0, 1], [0.5, 0.5]), 0.5).first()
    assert (row.true_positives, row.false_positives) == (1, 1)


def test_single_class(spark):
    row = metrics.metrics(frame(spark, [0, 0], [0.2, 0.9])).first()
    assert row.roc_auc is None and row.recall == 0.0 and row.false_negative_rate == 0.0


def test_known_values(spark):
    row = metrics.metrics(scored(spark, SMALL)).first()
    assert row.n == 6000
    assert row.roc_auc == pytest.approx(0.833777569, abs=1e-9)
    assert row.pr_auc == pytest.approx(0.739096610, abs=1e-9)
    assert (row.true_positives, row.false_positives, row.false_negatives, row.true_negatives) == (710, 117, 1258, 3915)


def test_suite_agrees_with_row_level_metrics(spark):
    df = scored(spark, SMALL)
    suite = metrics.metrics(df, 0.3).first()
    plain = metrics.with_rates(metrics.confusion(df, threshold=0.3)).first()
    for c in ("accuracy", "precision", "recall", "specificity", "f1", "n", "n_defaults"):
        assert suite[c] == pytest.approx(plain[c])
    assert suite.brier_score == pytest.approx(metrics.brier(df).first()[0])
    assert suite.log_loss == pytest.approx(metrics.log_loss(df).first()[0])


def test_curve_end_points(spark):
    df = scored(spark, SMALL)
    roc = curves.roc_points(df, ranges=9).orderBy("fpr", "tpr").collect()
    assert (roc[0].fpr, roc[0].tpr) == (0.0, 0.0) and (roc[-1].fpr, roc[-1].tpr) == (1.0, 1.0)
    pr = {r.threshold: r for r in curves.pr_points(df, ranges=9).collect()}
    assert (pr[None].precision, pr[None].recall) == (1.0, 0.0)
    assert pr[min(t for t in pr if t is not None)].recall == 1.0


def test_grid_position_is_exact_at_and_around_thresholds(spark):
    probes = [x for t in POLICY.grid for x in (t, np.nextafter(t, 0), np.nextafter(t, 1))]
    probes += [0.0, 1.0, -3.0, 7.0, 0.049, 0.81]
    df = spark.createDataFrame([(float(x),) for x in probes], "p double")
    found = df.selectExpr("p", f"{thresholds.grid_position('p')} AS k").collect()
    for r in found:
        assert r.k == sum(t <= r.p for t in POLICY.grid), r.p


def test_sweep_against_one_threshold_at_a_time(spark):
    df = scored(spark, SMALL)
    table = {r.threshold: r for r in thresholds.sweep(df).collect()}
    assert len(table) == 76
    for t in (0.05, 0.17, 0.3, 0.8):
        one = metrics.with_rates(metrics.confusion(df, threshold=t)).first()
        assert table[t].precision == pytest.approx(one.precision)
        assert table[t].fnr == pytest.approx(one.false_negative_rate)
        assert table[t].expected_cost == 5 * one.false_negatives + one.false_positives
        assert table[t].expected_cost == metrics.cost_at(df, t).first().expected_cost


def test_choice_prefers_the_lowest_threshold_on_ties(spark):
    chosen = thresholds.select_threshold(frame(spark, [0, 1], [0.0, 1.0])).first()
    assert chosen.operating_threshold == chosen.f1_optimal_threshold == 0.05
    known = thresholds.select_threshold(scored(spark, SMALL)).first()
    assert (known.cost_optimal_threshold, known.expected_cost_operating) == (0.28, 2850.0)


def test_group_metrics(spark):
    df = frame(spark, [0, 1, 0, 1, 0, 1], [0.1, 0.9, 0.2, 0.8, 0.3, 0.7], list("aaabbb"))
    rows = {r.grp: r for r in groups.group_metrics(df, 0.5).collect()}
    assert set(rows) == {"a", "b"}
    assert (rows["a"].n, rows["a"].n_defaults, rows["a"].recall) == (3, 1, 1.0)
    assert rows["b"].selection_rate == pytest.approx(2 / 3)


def test_audit_labels_bands_and_disparity(make_clients, spark):
    df = make_clients(
        {"age": 25, "sex": 1, "default_payment_next_month": 1},
        {"age": 26, "sex": 2},
        {"age": 0, "sex": None, "marriage": 9},
        {"age": None, "sex": 1},
    ).selectExpr("*", "if(id <= 2, 0.9D, 0.1D) AS p")
    rows = {(r.attribute, r.group): r for r in groups.audit(df, 0.5, "p", "default_payment_next_month").collect()}
    assert {k for k in rows if k[0] == "age_band"} == {("age_band", b) for b in ("<=25", "26-35", "unknown")}
    assert rows["sex", "unknown"].n == 1 and rows["sex", "male"].n == 2
    assert rows["marriage", "9"].n == 1
    assert rows["age_band", "unknown"].n == 2
    spread = {(r.attribute, r.metric): r for r in groups.disparity(groups.audit(df, 0.5, "p", "default_payment_next_month")).collect()}
    assert len(spread) == 12
    assert spread["sex", "selection_rate"].spread == pytest.approx(1.0)


def test_comparison_rounds_quality_columns(spark):
    one = metrics.metrics(scored(spark, SMALL))
    row = metrics.comparison([("first", one), ("second", one)]).orderBy("model").first()
    assert row.model == "first" and row.roc_auc == 0.8338 and row.n == 6000


@pytest.mark.parametrize("ranges", [None, 3])
@pytest.mark.parametrize("odd", [None, float("nan")])
def test_a_missing_score_raises_at_every_size(spark, ranges, odd):
    df = spark.createDataFrame([(0.1, 0), (0.2, 1), (0.3, 0), (odd, 1)], "p double, y int")
    with pytest.raises(Exception, match="without a score"):
        curves.areas(df, ranges=ranges).collect()


def test_ranges_cumulate_many_distinct_scores(spark):
    """Two million scores in 50 ranges: the areas follow from sums known in closed form."""
    n = 2_000_000
    df = spark.range(n).selectExpr("id / 2e6D AS p", "cast(id % 2 AS int) AS y")
    ranked = curves.ranked_counts(df, ranges=50)
    row = ranked.selectExpr(
        "count(*) AS n", "sum(pos_above) AS pos_above", "sum(neg_above) AS neg_above", f"{curves.ROC_AUC} AS auc"
    ).first()
    half = n // 2
    # over odd ids: (half - 1) ... 0 above; over even ones: half ... 1
    assert row["n"] == n and row["pos_above"] == half * (half - 1) // 2 + half * (half + 1) // 2
    assert row["neg_above"] == 2 * (half * (half - 1) // 2)
    assert row["auc"] == pytest.approx(0.5 + 0.5 / half, abs=1e-9)
