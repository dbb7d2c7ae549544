import pytest
from pyspark.sql import functions as F

from arrearscope.operators.metrics import metrics
from arrearscope.operators.validation import DataValidationError
from arrearscope.roles import CLIENT_SCHEMA, ROLES, TARGET
from arrearscope.session import scratch_path, scratch_root, written
from arrearscope.sources import clients as c
from arrearscope.sources import reports, runs
from arrearscope.sources.statements import scored

from conftest import SMALL


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_columnar_round_trip(spark, clients, fmt):
    path = scratch_path(spark, fmt)
    c.to_raw(clients).write.format(fmt).save(path)
    back = c.load_clients(spark, path, fmt)
    assert back.schema == CLIENT_SCHEMA
    assert back.exceptAll(clients).isEmpty() and clients.exceptAll(back).isEmpty()


def test_csv_with_banner_and_header(spark, clients):
    path = scratch_path(spark, "csv")
    header = [f.name for f in c.RAW_SCHEMA.fields]
    banner = ["", *[f"X{i}" for i in range(1, 24)], "Y"]
    text = c.to_raw(clients).selectExpr(*[f"cast(`{h}` AS string) AS `{h}`" for h in header])
    top = spark.createDataFrame([tuple(banner), tuple(header)], text.schema)
    top.unionByName(text).repartition(3).write.csv(path)
    back = c.load_clients(spark, path, "csv")
    assert back.schema.names == list(ROLES.ordered)
    assert back.exceptAll(clients).isEmpty() and clients.exceptAll(back).isEmpty()


def test_malformed_csv_number_raises(spark, clients):
    path = scratch_path(spark, "csv")
    rows = c.to_raw(clients.limit(1)).selectExpr(*[f"cast(`{f.name}` AS string) AS `{f.name}`" for f in c.RAW_SCHEMA.fields])
    rows.withColumn("AGE", F.lit("forty")).write.csv(path)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        c.load_clients(spark, path, "csv").collect()


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="xls"):
        c.load_clients(spark, "x", "xls")


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0)], "id long, limit_bal double")
    assert [r.limit_bal for r in c.nan_to_null(df).orderBy("id").collect()] == [None, 3.0]


def test_projection_drops_unknown_columns(clients):
    mixed = clients.select("age", F.lit(1).alias("other"), "id")
    assert c.project_canonical(mixed).columns == ["id", "age"]


def test_fingerprint(clients):
    def mark(df, **kw):
        return c.fingerprint(df, **kw).first()[0]

    base = mark(clients)
    assert len(base) == 16
    assert base == mark(clients) == mark(clients.repartition(5, "age").orderBy(F.desc("id")))
    flipped = clients.withColumn(TARGET, F.when(F.col("id") == 3, 1 - F.col(TARGET)).otherwise(F.col(TARGET)))
    assert base != mark(flipped)
    other = clients.withColumn("age", F.lit(1))
    assert base == mark(other) and mark(clients, columns=("id", "age")) != mark(other, columns=("id", "age"))
    assert c.preview(clients).first().fingerprint == base


def test_written_tables_are_plain_scans(spark, clients):
    table = written(clients.withColumn("part", F.col("id") % 3), "scan", ("part",))
    plan = table.filter("part = 1").select("age")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "ReadSchema: struct<age:int>" in plan
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_runs(spark):
    path = scratch_path(spark, "runs")
    for name, value in (("a", 0.5), ("b", 0.7), ("c", 0.6)):
        runs.append_run(runs.run_row(spark, name, {"pr_auc": value, "absent": None}, {"C": 1}, run_id=f"id-{name}"), path)
    found = runs.read_runs(spark, path)
    assert found.count() == 3
    best = runs.best_run(found).first()
    assert (best.model_name, best.value, best.params) == ("b", 0.7, {"C": "1"})
    assert runs.new_run_id() != runs.new_run_id()
    # a repeated job replaces its run and leaves the others as they are
    others = {r.run_id: r.created_at for r in found.collect()}
    again = runs.run_row(spark, "b again", {"pr_auc": 0.65}, run_id="id-b")
    for _ in range(2):
        runs.append_run(again, path)
    after = {r.run_id: r for r in runs.read_runs(spark, path).collect()}
    assert set(after) == set(others) and after["id-b"].model_name == "b again"
    assert all(after[i].created_at == others[i] for i in ("id-a", "id-c"))
    assert runs.read_runs(spark, path).columns == runs.RUN_SCHEMA.fieldNames()


def test_reports(spark):
    table = metrics(scored(spark, SMALL))
    path = reports.write_json(table, scratch_path(spark, "json"))
    assert reports.read_json(spark, path, table.schema).collect() == table.collect()
    importance = spark.createDataFrame([("f", 0.5, "l")], reports.IMPORTANCE_SCHEMA)
    good = reports.write_csv(importance, scratch_path(spark, "imp"))
    assert reports.read_importance(spark, good).collect() == importance.collect()
    bad = reports.write_csv(importance.drop("label"), scratch_path(spark, "imp"))
    with pytest.raises(DataValidationError):
        reports.read_importance(spark, bad)


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_an_absent_column_raises(spark, clients, fmt):
    path = scratch_path(spark, "absent")
    c.to_raw(clients).drop(c.CANONICAL_TO_RAW["limit_bal"]).write.format(fmt).save(path)
    with pytest.raises(ValueError, match=c.CANONICAL_TO_RAW["limit_bal"]):
        c.load_clients(spark, path, fmt)


def test_csv_columns_are_taken_by_name(spark, clients):
    raw = c.to_raw(clients)
    swapped = raw.select(*reversed(raw.columns))
    path = scratch_path(spark, "swapped")
    swapped.coalesce(1).write.option("header", True).csv(path)
    assert sorted(c.load_clients(spark, path, "csv").collect()) == sorted(clients.select(*c.load_clients(spark, path, "csv").columns).collect())
    for changed, message in ((raw.withColumnRenamed(raw.columns[3], "other"), raw.columns[3]), (raw.withColumn("more", raw[raw.columns[0]]), "more")):
        path = scratch_path(spark, "changed")
        changed.write.option("header", True).csv(path)
        with pytest.raises(ValueError, match=message):
            c.load_clients(spark, path, "csv")
