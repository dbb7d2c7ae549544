import pytest

from arrearscope.operators.explanation import explained
from arrearscope.operators.validation import DataValidationError, quarantine
from arrearscope.roles import FEATURES
from arrearscope.session import scratch_path
from arrearscope.streaming import scoring as s


@pytest.fixture
def arrivals(spark, clients):
    path = scratch_path(spark, "arrivals")
    clients.select("id", *FEATURES).repartition(3).write.parquet(path)
    return s.read_applications(spark, path, files_per_batch=1)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_stream_scores_equal_batch_scores(spark, card, clients, arrivals):
    out, offsets = scratch_path(spark, "out"), scratch_path(spark, "offsets")
    s.score_stream(card, arrivals, out, offsets).awaitTermination()
    expected = card.payload(clients.select("id", *FEATURES))
    assert same(spark.read.parquet(out), expected)
    # a restart from the same offsets finds nothing new
    s.score_stream(card, arrivals, out, offsets).awaitTermination()
    assert spark.read.parquet(out).count() == clients.count()


def test_quarantine_routes_every_row_once(spark, card, clients, arrivals):
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    s.quarantine_stream(card, arrivals, good, bad, scratch_path(spark, "offsets")).awaitTermination()
    valid, invalid = quarantine(clients.select("id", *FEATURES))
    assert same(spark.read.parquet(good).drop("batch"), card.payload(valid))
    assert same(spark.read.parquet(bad).drop("batch"), invalid)


def test_stream_explanations_equal_batch(spark, card, clients, arrivals):
    out = scratch_path(spark, "explained")
    s.explain_stream(card, arrivals, out, scratch_path(spark, "offsets")).awaitTermination()
    assert same(spark.read.parquet(out).drop("batch"), explained(card, clients.select("id", *FEATURES)))


def test_unexpected_columns_are_refused(card, arrivals):
    with pytest.raises(DataValidationError, match="annual_income"):
        s.score_stream(card, arrivals.selectExpr("*", "1 AS annual_income"), "/tmp/unused", "/tmp/unused")
