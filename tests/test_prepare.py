import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.errors import DataValidationError, ExplanationError, InvalidFeatureSchemaError
from lendspark.operators import explain
from lendspark.plans import prepare, training as tr
from lendspark.plans.prepare import PrepareColumns, PreparedColumns, schema_problems
from lendspark.sources import sinks

SHAPE = "id long, a double, b double, c int, kind string, grade string, loan_status int"
NAN = float("nan")
ROWS = [
    (1, 1.0, None, 5, "x", None, 0), (2, None, None, 5, "y", "A", 1), (3, 7.0, None, 5, "x", "B", 0),
    (4, NAN, None, 5, "x", "A", 1), (5, 3.0, None, 5, "y", "B", 1), (6, 11.0, None, 5, "x", "B", 0),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SHAPE)


@pytest.fixture(scope="module")
def fitted(rows):
    return PrepareColumns(numeric=["a", "b", "c", "gone"], categorical=["kind", "grade"]).fit(rows)


def test_decides_per_column(fitted):
    assert sorted(map(str, fitted.decisions())) == sorted(map(str, [
        ("gone", "absent", None, None, None), ("b", "dropped", 6, None, None), ("a", "filled and flagged", 2, 5.0, None),
        ("c", "number", 0, 5.0, None), ("kind", "category", 0, None, 2), ("grade", "category", 1, None, 2),
    ]))


def test_places_of_the_vector(fitted, rows, spark):
    assert [s for s, _ in fitted.slots()] == ["a", "a", "c", "kind", "kind", "grade", "grade", "grade"]
    filled = [1.0, 5.0, 7.0, 5.0, 3.0, 11.0]
    mean = sum(filled) / 6
    scale = math.sqrt(sum((x - mean) ** 2 for x in filled) / 5)
    got = {r.id: r.v for r in fitted.transform(rows).select("id", vector_to_array("features").alias("v")).collect()}
    assert got[1] == pytest.approx([(1 - mean) / scale, 0, 0, 1, 0, 0, 0, 1])
    assert got[4] == pytest.approx([(5 - mean) / scale, 1, 0, 1, 0, 1, 0, 0])  # NaN is missing; a constant column adds 0
    new = spark.createDataFrame([(9, None, 1.0, None, "unseen", "C", None)], SHAPE)
    assert fitted.transform(new).select(vector_to_array("features")).first()[0] == pytest.approx([(5 - mean) / scale, 1, 0, 0, 0, 0, 0, 0])


def test_saved_and_loaded(fitted, rows, tmp_path):
    path = str(tmp_path / "m")
    PipelineModel([fitted]).write().save(path)
    back = PipelineModel.load(path).stages[0]
    assert isinstance(back, PreparedColumns) and back.decided == fitted.decided
    assert back.transform(rows).exceptAll(fitted.transform(rows)).isEmpty()


def test_refusals(rows, fitted, monkeypatch):
    with pytest.raises(DataValidationError, match="no training rows"):
        PrepareColumns(numeric=["a"]).fit(rows.where("false"))
    with pytest.raises(DataValidationError, match="no column holds a value"):
        PrepareColumns(numeric=["b"]).fit(rows)
    with pytest.raises(InvalidFeatureSchemaError, match="missing column kind"):
        fitted.transform(rows.drop("kind"))
    monkeypatch.setattr(prepare, "MOST_VALUES", 1)
    with pytest.raises(DataValidationError, match="grade, kind"):
        PrepareColumns(categorical=["kind", "grade"]).fit(rows)


def test_schema_problems():
    found = T.StructType().add("a", "integer").add("b", "double").add("c", "string").add("id", "long")
    assert schema_problems({"a": "bigint", "b": "double", "c": "string"}, found) == []
    assert schema_problems({"a": "smallint", "b": "int", "c": "double", "d": "int"}, found) == [
        "missing column d", "column a is int, not smallint", "column b is double, not int", "column c is string, not double"]
    assert schema_problems({"a": "int", "b": "double", "c": "string"}, found, extra=()) == ["unexpected column id"]


def test_contributions_of_a_fitted_model(rows):
    train = rows.unionByName(rows.withColumn("loan_status", 1 - F.col("loan_status"))).unionByName(rows)
    model = tr.train(train, tr.logistic(), numeric=["a", "b", "c"], categorical=["kind", "grade"], derived=[])
    intercept, parts = explain.fitted_impacts(model)
    assert sorted(parts) == ["a", "c", "grade", "kind"]
    out = explain.explain_fitted(model, model.transform(train).select("id", "a", "b", "c", "kind", "grade", "rawPrediction"))
    for r in out.collect():
        impacts = [e["impact"] for e in r["explanation"]]
        assert sum(impacts) + intercept == pytest.approx(r["rawPrediction"][1], abs=1e-12)
        assert impacts == sorted(impacts, key=lambda x: -abs(x))
    with pytest.raises(ExplanationError):
        explain.fitted_impacts(tr.train(train, tr.forest(numTrees=1), numeric=["a"], categorical=[], derived=[]))


def _predictions(spark, ids, version="1.0.0"):
    shape = "id string, latency_ms decimal(10,3), prediction_version string"
    return spark.createDataFrame([(i, None, version) for i in ids], shape)


def test_a_repeated_run_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "predictions")
    sinks.write_run(_predictions(spark, "abc"), path, "one", "2024-06-01")
    sinks.write_run(_predictions(spark, "de"), path, "two", "2024-06-01")
    sinks.write_run(_predictions(spark, "ab"), path, "one", "2024-06-01")
    sinks.write_run(_predictions(spark, "f", "2.0.0"), path, "07", "2024-06-02")
    schema = _predictions(spark, "a").schema
    stored = sinks.read_runs(spark, path, schema).collect()
    assert sorted((r.run_id, r.id, r.prediction_version, r.prediction_day) for r in stored) == [
        ("07", "f", "2.0.0", "2024-06-02"), ("one", "a", "1.0.0", "2024-06-01"), ("one", "b", "1.0.0", "2024-06-01"),
        ("two", "d", "1.0.0", "2024-06-01"), ("two", "e", "1.0.0", "2024-06-01")]
    assert all(r.latency_ms > 0 and r.created_at is not None for r in stored)
    assert {(r.run_id, r.n_rows) for r in sinks.read_manifest(spark, path).collect()} == {("one", 2), ("two", 2), ("07", 1)}


def test_unfinished_and_outdated_rows_are_not_seen(spark, tmp_path):
    path = str(tmp_path / "predictions")
    sinks.write_run(_predictions(spark, "abc"), path, "one", "2024-06-01")
    sinks.write_run(_predictions(spark, "ab", "2.0.0"), path, "one", "2024-06-01")  # the run again with another model
    broken = sinks.with_audit(_predictions(spark, "x")).selectExpr("*", "'2024-06-01' AS prediction_day", "'dead' AS run_id")
    broken.write.mode("append").partitionBy(*sinks.RUN_KEYS).parquet(path)  # partitions written, manifest not
    sinks.write_run(_predictions(spark, "ab"), path, "gone", "2024-06-01")
    sinks.write_run(_predictions(spark, ""), path, "gone", "2024-06-01")  # the run again, without rows
    stored = sinks.read_runs(spark, path, _predictions(spark, "a").schema).collect()
    assert sorted((r.run_id, r.id, r.prediction_version) for r in stored) == [("one", "a", "2.0.0"), ("one", "b", "2.0.0")]
