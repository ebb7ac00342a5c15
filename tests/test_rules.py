import math

import pytest
from pyspark.sql import functions as F

from lendspark.errors import BatchSizeExceededError, DataValidationError, InvalidFeatureSchemaError
from lendspark.operators import validate as val
from lendspark.schemas import APPLICATION

GOOD = dict(
    age=34, income=1450000.0, employment_years=6.0, home_ownership="RENT", loan_amount=500000.0,
    interest_rate=12.5, term_months=36, loan_intent="PERSONAL", credit_history_years=7, late_payments=1,
    previous_defaults=0, credit_utilization=0.42, active_credit_lines=4,
)
CASES = [
    ({}, []),
    ({"income": -1.0}, [("income", "range")]),
    ({"income": math.nan}, [("income", "range")]),
    ({"income": 0.0}, []),
    ({"loan_amount": 0.0}, [("loan_amount", "range")]),
    ({"age": 121}, [("age", "range")]),
    ({"age": 120}, [("age", "range")]),
    ({"age": 119}, []),
    ({"age": 0}, [("age", "range")]),
    ({"home_ownership": "PALACE"}, [("home_ownership", "category")]),
    ({"home_ownership": "rent"}, [("home_ownership", "category")]),
    ({"credit_utilization": 1.5}, [("credit_utilization", "range")]),
    ({"credit_utilization": 1.0}, []),
    ({"age": None}, [("age", "missing")]),
    ({"employment_years": None}, [("employment_years", "missing")]),
    ({"interest_rate": -0.1}, [("interest_rate", "range")]),
    ({"term_months": 0}, [("term_months", "range")]),
    ({"loan_intent": "YACHT"}, [("loan_intent", "category")]),
    (
        dict(term_months=None, late_payments=None, previous_defaults=None, credit_utilization=None,
             active_credit_lines=None),
        [],
    ),
    (
        {"age": None, "income": -5.0, "loan_intent": None, "active_credit_lines": -1},
        [("age", "missing"), ("loan_intent", "missing"), ("income", "range"), ("active_credit_lines", "range")],
    ),
]


@pytest.fixture(scope="module")
def cases(spark):
    rows = [tuple({**GOOD, **change}[c] for c in APPLICATION.fieldNames()) for change, _ in CASES]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in APPLICATION.fields))
    return df


def test_every_violation_is_reported(cases):
    got = {r["id"]: [tuple(v) for v in r["v"]] for r in cases.select("id", val.violations(val.REQUEST).alias("v")).collect()}
    for i, (_, expected) in enumerate(CASES):
        assert got[i] == expected, CASES[i]


def test_valid_rows_and_quarantine_agree(cases):
    expected = {i for i, (_, v) in enumerate(CASES) if not v}
    assert {r["id"] for r in val.valid_rows(cases).collect()} == expected
    good, bad = val.quarantine_split(cases)
    assert {r["id"] for r in good.collect()} == expected
    assert good.count() + bad.count() == len(CASES)
    assert bad.where(F.size("violations") == 0).count() == 0


def test_training_rules_allow_what_is_imputed(cases):
    ids = {r["id"] for r in val.valid_rows(cases, val.TRAINING).collect()}
    assert next(i for i, (c, _) in enumerate(CASES) if c == {"employment_years": None}) in ids


def test_gate(cases):
    with pytest.raises(DataValidationError, match="age/missing: 2"):
        val.strict_gate(cases)
    assert val.strict_gate(val.valid_rows(cases)).count() > 0
    assert val.strict_gate(cases, max_bad_share=1.0).count() == len(CASES)


def test_output_rules(spark):
    rows = [
        (0, 0.5, 50, "MEDIUM", [("a", 0.1, "positive")]),
        (1, None, 50, "MEDIUM", []),
        (2, math.nan, 50, "MEDIUM", []),
        (3, 1.01, 101, "EXTREME", [("a", 0.1, "sideways")]),
        (4, -0.01, 0, "LOW", [("a", 0.1, None)]),
    ]
    df = spark.createDataFrame(
        rows, "id int, default_probability double, risk_score int, risk_level string, "
        "explanation array<struct<feature:string,impact:double,direction:string>>")
    got = {(r["id"], r["field"]) for r in val.row_violations(df, "id", val.OUTPUT).collect()}
    p, s, v, e = "default_probability", "risk_score", "risk_level", "explanation"
    assert got == {(1, p), (2, p), (3, p), (3, s), (3, v), (3, e), (4, p), (4, e)}


def test_uuid_rule(spark):
    df = spark.createDataFrame(
        [(0, "123e4567-e89b-12d3-a456-426614174000"), (1, "123e4567"), (2, None), (3, "x" * 36)], "id int, u string")
    assert sorted(r["id"] for r in val.row_violations(df, "id", [val.uuid_rule("u")]).collect()) == [1, 2, 3]


def test_batch_limit(spark):
    df = spark.range(0, 12).withColumn("batch", F.col("id") % 2)
    assert val.check_batches(df, "batch", 6) is df
    with pytest.raises(BatchSizeExceededError):
        val.check_batches(df, "batch", 5)


def test_required_columns(spark, cases):
    val.require_columns(cases, APPLICATION)
    with pytest.raises(InvalidFeatureSchemaError, match="age"):
        val.require_columns(cases.withColumn("age", F.col("age").cast("string")), APPLICATION)
    with pytest.raises(InvalidFeatureSchemaError, match="income"):
        val.require_columns(cases.drop("income"), APPLICATION)
    assert val.schema_contract(cases, APPLICATION).count() == 0
