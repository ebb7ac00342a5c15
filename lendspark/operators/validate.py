"""Row rules: every violation per row, quarantine, fail-fast gate, key and schema checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.errors import BatchSizeExceededError, DataValidationError, InvalidFeatureSchemaError
from lendspark.schemas import (
    AGE_MAX_EXCLUSIVE,
    AGE_MIN_EXCLUSIVE,
    DIRECTION,
    HOME_OWNERSHIP,
    LOAN_GRADE,
    LOAN_INTENT,
    MAX_BATCH_ITEMS,
    REQUIRED,
    RISK_LEVEL,
    UUID_PATTERN,
    WORKING_AGE,
)


@dataclass(frozen=True)
class Rule:
    """``broken`` is SQL that is true for a violation; NULL counts as no violation."""

    field: str
    kind: str
    broken: str
    also: tuple[str, ...] = ()


def _missing(field: str) -> Rule:
    return Rule(field, "missing", f"{field} IS NULL")


def _whole(field: str, broken: str) -> Rule:
    return Rule(field, "range", broken.format(c=field))


def _number(field: str, broken: str) -> Rule:
    # NaN sorts above every number, so a lower bound alone would let it pass.
    return Rule(field, "range", f"{broken.format(c=field)} OR isnan({field})")


def _one_of(field: str, allowed: Sequence[str]) -> Rule:
    values = ", ".join(f"'{v}'" for v in allowed)
    return Rule(field, "category", f"{field} NOT IN ({values})")


_VALUES = (
    _whole("age", f"{{c}} <= {AGE_MIN_EXCLUSIVE} OR {{c}} >= {AGE_MAX_EXCLUSIVE}"),
    _number("income", "{c} < 0"),
    _number("employment_years", "{c} < 0"),
    _one_of("home_ownership", HOME_OWNERSHIP),
    _number("loan_amount", "{c} <= 0"),
    _number("interest_rate", "{c} < 0"),
    _whole("term_months", "{c} <= 0"),
    _one_of("loan_intent", LOAN_INTENT),
    _whole("credit_history_years", "{c} < 0"),
    _whole("late_payments", "{c} < 0"),
    _whole("previous_defaults", "{c} < 0"),
    _number("credit_utilization", "{c} NOT BETWEEN 0 AND 1"),
    _whole("active_credit_lines", "{c} < 0"),
)
#: Columns the raw training file leaves empty; training imputes them.
MAY_BE_MISSING_IN_TRAINING = ("employment_years", "interest_rate")

REQUEST = tuple(_missing(f) for f in REQUIRED) + _VALUES
TRAINING = (
    tuple(_missing(f) for f in REQUIRED if f not in MAY_BE_MISSING_IN_TRAINING) + _VALUES
)
LOAN_RECORD = (
    _one_of("loan_grade", LOAN_GRADE),
    _whole("loan_status", "{c} NOT IN (0, 1)"),
)
PLAUSIBLE = (
    Rule("employment_years", "implausible", f"employment_years > age - {WORKING_AGE}", ("age",)),
)
EXTENDED = REQUEST + LOAN_RECORD + PLAUSIBLE

_DIRECTIONS = ", ".join(f"'{d}'" for d in DIRECTION)
OUTPUT = (
    # BETWEEN rejects NaN; NULL is an error here as well.
    Rule("default_probability", "range", "NOT coalesce(default_probability BETWEEN 0 AND 1, false)"),
    _whole("risk_score", "{c} NOT BETWEEN 0 AND 100"),
    _one_of("risk_level", RISK_LEVEL),
    Rule(
        "explanation",
        "category",
        f"exists(explanation, e -> NOT coalesce(e.direction IN ({_DIRECTIONS}), false))",
    ),
)


def applicable(rules: Iterable[Rule], columns: Iterable[str]) -> list[Rule]:
    """The rules that the table can answer. A required column that is absent is missing in every row;
    other rules over absent columns say nothing."""
    have = set(columns)
    found = []
    for r in rules:
        if {r.field, *r.also} <= have:
            found.append(r)
        elif r.kind == "missing":
            found.append(Rule(r.field, r.kind, "true"))
    return found


def violations(rules: Iterable[Rule]) -> Column:
    """All violations of a row as ``array<struct<field, kind>>``, in rule order."""
    found = ", ".join(
        f"CASE WHEN {r.broken} THEN named_struct('field', '{r.field}', 'kind', '{r.kind}') END"
        for r in rules
    )
    return F.expr(f"array_compact(array({found}))")


def is_valid(rules: Iterable[Rule]) -> Column:
    """No rule is broken. One CASE, so evaluation stops at the first broken rule."""
    branches = " ".join(f"WHEN {r.broken} THEN false" for r in rules)
    return F.expr(f"CASE {branches} ELSE true END") if branches else F.lit(True)


def valid_rows(df: DataFrame, rules: Iterable[Rule] = REQUEST) -> DataFrame:
    return df.where(is_valid(applicable(rules, df.columns)))


def quarantine_split(df: DataFrame, rules: Iterable[Rule] = REQUEST) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantined)``; quarantined rows carry ``violations``."""
    rules = applicable(rules, df.columns)
    good = is_valid(rules)
    return df.where(good), df.where(~good).withColumn("violations", violations(rules))


def row_violations(df: DataFrame, key: str, rules: Iterable[Rule] = REQUEST) -> DataFrame:
    """One row per ``(row, violation)``: key, field, kind."""
    rules = applicable(rules, df.columns)
    return df.select(key, F.explode(violations(rules)).alias("v")).select(key, "v.field", "v.kind")


def rule_counts(df: DataFrame, rules: Iterable[Rule] = REQUEST) -> DataFrame:
    """Violations per rule, rules without any included. One pass, one output row per rule."""
    rules = applicable(rules, df.columns)
    wide = df.agg(*[F.expr(f"count_if({r.broken})").alias(f"r{i}") for i, r in enumerate(rules)])
    rows = ", ".join(f"'{r.field}', '{r.kind}', r{i}" for i, r in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {rows}) AS (field, kind, n)")


def strict_gate(
    df: DataFrame, rules: Iterable[Rule] = REQUEST, max_bad_share: float = 0.0
) -> DataFrame:
    """Return ``df`` unchanged, or stop with every broken rule and its count.

    The check runs eagerly: an assertion inside a projection would be dropped
    whenever its column is not used.
    """
    rules = applicable(rules, df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~is_valid(rules)).alias("bad"),
        *[F.expr(f"count_if({r.broken})").alias(f"r{i}") for i, r in enumerate(rules)],
    ).first()
    if row["bad"] > max_bad_share * row["rows"]:
        broken = ", ".join(
            f"{r.field}/{r.kind}: {row[f'r{i}']}" for i, r in enumerate(rules) if row[f"r{i}"]
        )
        raise DataValidationError(f"{row['bad']} of {row['rows']} rows are invalid ({broken})")
    return df


def uuid_rule(field: str) -> Rule:
    return Rule(field, "format", f"NOT coalesce({field} RLIKE '{UUID_PATTERN}', false)")


def decimal_rule(field: str, precision: int, scale: int) -> Rule:
    """The value must fit ``DECIMAL(precision, scale)``."""
    fits = f"try_cast({field} AS DECIMAL({precision}, {scale}))"
    return Rule(field, "decimal", f"{field} IS NOT NULL AND {fits} IS NULL")


def length_rule(field: str, limit: int) -> Rule:
    return Rule(field, "length", f"length({field}) > {limit}")


def missing_at_input(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL and NaN counts of model input columns, one row per column."""
    types = dict(df.dtypes)
    gone = {
        c: f"{c} IS NULL OR isnan({c})" if types[c] in ("double", "float") else f"{c} IS NULL"
        for c in columns
    }
    wide = df.agg(*[F.expr(f"count_if({g})").alias(c) for c, g in gone.items()])
    rows = ", ".join(f"'{c}', {c}" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {rows}) AS (column, n_missing)")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that should be unique and are not, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def oversized_batches(df: DataFrame, batch: str, limit: int = MAX_BATCH_ITEMS) -> DataFrame:
    """Request batches above the limit. A limit on one request, not on the table."""
    return df.groupBy(batch).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)


def check_batches(df: DataFrame, batch: str, limit: int = MAX_BATCH_ITEMS) -> DataFrame:
    worst = df.groupBy(batch).count().agg(F.max("count").alias("n")).first()["n"] or 0
    if worst > limit:
        raise BatchSizeExceededError(f"a batch holds {worst} items, the limit is {limit}")
    return df


def schema_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Contract columns with the type found and how many values do not convert.

    One row per column that is absent, or has another type, in the given table.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    off = [f for f in contract.fields if found.get(f.name) != f.dataType]
    present = [f for f in off if f.name in found]
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.count(
                F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), 1)
            ).alias(f.name)
            for f in present
        ],
    )
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("expected"),
            F.lit(found[f.name].simpleString() if f.name in found else None)
            .cast("string")
            .alias("actual"),
            (F.col(f.name) if f.name in found else F.col("_rows")).alias("n_bad"),
        )
        for f in off
    ]
    if not rows:
        return df.sparkSession.createDataFrame(
            [], "column string, expected string, actual string, n_bad bigint"
        )
    return wide.select(F.inline(F.array(*rows)))


def require_columns(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Raise unless every expected column is there with its type (order is free)."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in expected.fields if found.get(f.name) != f.dataType]
    if wrong:
        raise InvalidFeatureSchemaError(f"missing or differently typed columns: {', '.join(wrong)}")
    return df
