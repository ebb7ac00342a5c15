"""Edges of the rules: absent columns, NULL keys and values, colliding keys, swapped headers."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.errors import DataValidationError
from lendspark.functions.scalar import stable_id
from lendspark.operators import history, relational, running, validate
from lendspark.sources import readers


def test_absent_required_column_is_missing_in_every_row(spark):
    df = spark.createDataFrame([(1,), (2,)], "application_id int")
    assert validate.valid_rows(df).count() == 0
    with pytest.raises(DataValidationError):
        validate.strict_gate(df)
    good, bad = validate.quarantine_split(df)
    assert (good.count(), bad.count()) == (0, 2)


def test_history_of_rows_without_key_or_moment(spark):
    day = [datetime(2024, 1, d) for d in (1, 3)]
    rows = [(1, None, day[0], 5), (2, None, day[1], 7), (3, "a", day[1], 1), (4, "a", None, 2)]
    df = spark.createDataFrame(rows, "id int, key string, at timestamp_ntz, n int")
    out = history.with_history(df, "key", "at", {"past": "CAST(n AS DECIMAL(14,2))"})
    assert {r["id"]: int(r["past"]) for r in out.collect()} == {1: 0, 2: 5, 3: 0, 4: 0}
    assert out.schema["past"].dataType == T.DecimalType(24, 2)


def test_running_totals_keep_null_values_with_and_without_parts(spark):
    df = spark.createDataFrame([(None, 2), (0.1, 1), (0.5, 3), (0.9, 4)], "v double, n long")
    whole = running.running_totals(df, "v", ["n"]).collect()
    parts = running.running_totals(df, "v", ["n"], edges=[0.3, 0.7]).collect()
    key = lambda r: (r["v"] is not None, r["v"] or 0)
    assert sorted(map(tuple, whole), key=str) == sorted(map(tuple, parts), key=str)
    assert [r["n_below"] for r in sorted(parts, key=key)] == [0, 2, 3, 6]


def test_keys_do_not_collide(spark):
    rows = [("a|b", "c", None), ("a", "b|c", None), ("a", None, "b|c"), ("a", "b", "c"), ("a\\", "|b", "c"), ("a", "\\N", "b|c")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    assert df.select(stable_id("x", "y", "z")).distinct().count() == len(rows)


def test_shape_keeps_previous_defaults(spark):
    out = relational.to_shape(spark.createDataFrame([(1,)], "previous_defaults int"))
    assert out.select("previous_default").first()[0] == 1


def test_value_beyond_its_decimal_is_null(spark):
    rows = [(1, 1, 100.0, 1000.0, 36, "PERSONAL", "A", 0, 10.0)]
    df = spark.createDataFrame(
        rows,
        "application_id int, customer_id int, loan_amount double, interest_rate double, term_months int, "
        "loan_intent string, loan_grade string, loan_status int, income double",
    )
    row = relational.normalise_loans(df).first()
    assert row["interest_rate"] is None and row["amount"] == 100


def test_swapped_header_stops(spark, tmp_path):
    path = str(tmp_path / "csv")
    shape = T.StructType.fromDDL("age int, income double")
    spark.createDataFrame([(34, 59000.0)], shape).select("income", "age").write.option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_applications_csv(spark, path, shape).agg(F.sum("age"), F.sum("income")).collect()
