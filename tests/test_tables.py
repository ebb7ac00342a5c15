from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lendspark.operators import profile
from lendspark import schemas as sch
from lendspark.errors import EntityNotFoundError
from lendspark.functions.features import add_derived_features
from lendspark.operators import relational as rel
from lendspark.operators.profile import add_class_weight, distinct_counts
from lendspark.operators.validate import decimal_rule, row_violations
from lendspark.sources import readers, sinks
from lendspark.sources.views import applications


@pytest.fixture(scope="module")
def apps(spark, sf):
    return applications(spark, sf).cache()


def test_tables_have_the_declared_types(apps):
    for table, contract in (
        (rel.normalise_customers(apps), sch.CUSTOMERS),
        (rel.normalise_loans(apps), sch.LOANS),
        (rel.normalise_credit_histories(apps), sch.CREDIT_HISTORIES),
    ):
        want = {f.name: f.dataType for f in contract.fields}
        for f in table.schema.fields:
            if f.name not in ("id", "customer_id"):  # keys are BIGINT in the test data
                assert f.dataType == want[f.name], f.name
        assert set(table.columns) == set(want)


def test_one_customer_and_one_history_each(apps):
    n = apps.select("customer_id").distinct().count()
    assert rel.normalise_customers(apps).count() == n
    histories = rel.normalise_credit_histories(apps)
    assert histories.count() == n == histories.select("customer_id").distinct().count()


def test_lookup(apps):
    assert rel.lookup_one(apps, "application_id", 5)["application_id"] == 5
    with pytest.raises(EntityNotFoundError):
        rel.lookup_one(apps, "application_id", -5)


def test_ratio_overflow_becomes_null_and_is_reported(spark):
    df = spark.createDataFrame([(1, 99.9), (2, 9.9999), (3, None)], "id int, r double")
    assert [r["id"] for r in row_violations(df, "id", [decimal_rule("r", 5, 4)]).collect()] == [1]
    loans = rel.normalise_loans(
        spark.createDataFrame(
            [(1, 1, 100.0, 5.0, 36, "PERSONAL", "A", 0, 2.0), (2, 1, 1.0, 5.0, 36, "PERSONAL", "A", 0, 2.0)],
            "application_id int, customer_id int, loan_amount double, interest_rate double, term_months int, "
            "loan_intent string, loan_grade string, loan_status int, income double"))
    got = {r["id"]: r["loan_percent_income"] for r in loans.collect()}
    assert got == {1: None, 2: Decimal("0.5000")}


def test_derived_features_edge_cases(spark):
    rows = [
        (100.0, 0.0, 50.0, 0.5, 0, 0, 3),
        (100.0, 200.0, None, None, 10, None, None),
        (100.0, -5.0, 50.0, 4.0, 10, 20, 5),
    ]
    df = spark.createDataFrame(
        rows, "loan_amount double, income double, total_debt double, employment_years double, "
        "credit_history_years int, age int, late_payments int")
    a, b, c = add_derived_features(df).select(
        "loan_to_income", "debt_to_income", "income_per_employment_year", "credit_age_ratio", "late_payment_rate").collect()
    assert tuple(a) == (None, None, 0.0, 0.0, 3.0)
    assert tuple(b) == (0.5, None, None, None, None)
    assert tuple(c) == (None, None, -1.25, 0.5, 0.5)
    assert "debt_to_income" not in add_derived_features(df.drop("total_debt")).columns


def test_shape_and_flags(spark):
    raw = spark.createDataFrame([(30, "Y"), (31, "N"), (32, "?")], "age int, cb_person_default_on_file string")
    flags = raw.select(F.expr("age"), rel.yes_no_to_int("cb_person_default_on_file").alias("d")).collect()
    assert [r["d"] for r in flags] == [1, 0, None]
    assert rel.to_shape(raw).schema == sch.COMMON_SHAPE


def test_csv_with_bad_lines(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(
        ",".join(sch.RAW_FILE.fieldNames()) + "\n"
        "22,59000,RENT,123.0,PERSONAL,D,35000,16.02,1,0.59,Y,3\n"
        "21,9600,OWN,,EDUCATION,B,1000,,0,0.1,N,2\n"
        "old,1,RENT,1,PERSONAL,A,1,1,0,0.1,N,2\n")
    df = readers.read_raw_csv(spark, str(tmp_path / "raw.csv")).cache()
    assert df.count() == 3 and df.where("_corrupt IS NOT NULL").count() == 1
    assert df.where("person_emp_length IS NULL AND _corrupt IS NULL").count() == 1


def test_json_array_file(spark, tmp_path):
    (tmp_path / "batch.json").write_text('[{"age": 34, "income": 1.5, "extra": 1}, {"age": null, "loan_intent": "PERSONAL"}]')
    rows = readers.read_applications_json(spark, str(tmp_path / "batch.json"), multiline=True).collect()
    assert [(r["age"], r["income"], r["loan_intent"]) for r in rows] == [(34, 1.5, None), (None, None, "PERSONAL")]


def test_sinks(spark, tmp_path, apps):
    base = str(tmp_path)
    with pytest.raises(ValueError):
        sinks.write_zone(apps, base, "attic", "x")
    sinks.append_rows(rel.normalise_customers(apps), f"{base}/customers")
    sinks.append_rows(rel.normalise_customers(apps), f"{base}/customers")
    stored = spark.read.parquet(f"{base}/customers")
    assert stored.count() == 2 * rel.normalise_customers(apps).count()
    assert stored.where("created_at <> updated_at").count() == 0
    later = sinks.touch(stored)
    assert later.where("updated_at > created_at").count() == stored.count()
    for seed in (1, 2):
        sinks.append_experiment(
            spark, f"{base}/log", model="m", hyperparameters={"depth": 3}, features=["age"],
            dataset_version="d", metrics={"roc_auc": 0.7}, seed=seed, artifact="a")
    log = spark.read.json(f"{base}/log")
    assert log.count() == 2 == log.select("experiment_id").distinct().count()


def test_class_weight(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "loan_status int")
    assert sorted(r["weight"] for r in add_class_weight(df).collect()) == [1.0, 1.0, 1.0, 3.0]


def test_approximate_distinct_counts(apps):
    exact = {r["column"]: r["n_distinct"] for r in distinct_counts(apps, ["age", "term_months"]).collect()}
    near = {r["column"]: r["n_distinct"] for r in distinct_counts(apps, ["age", "term_months"], True).collect()}
    assert exact["term_months"] == near["term_months"] == 2
    assert abs(exact["age"] - near["age"]) <= 0.15 * exact["age"]


def test_profiles_of_nan_negative_zero_and_empty_columns(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 0.0, None), (2.0, -0.0, None), (3.0, 5.0, None), (nan, None, None), (900.0, 5.0, None)], "x double, z double, e double")
    assert {r["column"]: r["n_distinct"] for r in profile.distinct_counts(df, ["z"]).collect()} == {"z": 2}
    stats = {r["column"]: r for r in profile.numeric_profile(df, ["x", "e"]).collect()}
    assert (stats["x"]["n"], stats["x"]["max"], stats["x"]["mean"], stats["x"]["median"]) == (4, 900.0, 226.5, 2.5)
    assert (stats["e"]["n"], stats["e"]["median"], stats["e"]["mean"]) == (0, None, None)
    for columns in (["x", "e"], ["e"]):
        out = {r["column"]: (r["n_low"], r["n_high"], r["lower"] is None) for r in profile.outliers_iqr(df, columns).collect()}
        assert out == {c: (0, 1, False) if c == "x" else (0, 0, True) for c in columns}
