"""Derived features, as SQL expressions and as a transformer that is saved with a model."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.functions.scalar import at_least_one, ratio

#: Name -> (input columns, SQL).
DERIVED_SQL = {
    "loan_to_income": (("loan_amount", "income"), ratio("loan_amount", "income")),
    "debt_to_income": (("total_debt", "income"), ratio("total_debt", "income")),
    "income_per_employment_year": (
        ("income", "employment_years"),
        ratio("income", at_least_one("employment_years")),
    ),
    "credit_age_ratio": (
        ("credit_history_years", "age"),
        ratio("credit_history_years", at_least_one("age")),
    ),
    "late_payment_rate": (
        ("late_payments", "credit_history_years"),
        ratio("late_payments", at_least_one("credit_history_years")),
    ),
}
DERIVED = tuple(DERIVED_SQL)


def add_derived_features(df: DataFrame) -> DataFrame:
    """Append every derived feature whose inputs the table has."""
    have = set(df.columns)
    return df.withColumns(
        {name: F.expr(sql) for name, (needs, sql) in DERIVED_SQL.items() if set(needs) <= have}
    )


class DerivedFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``add_derived_features`` as a stage, so training and scoring share one definition."""

    @keyword_only
    def __init__(self):
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_derived_features(dataset)


def loan_percent_income(amount: str = "loan_amount", income: str = "income") -> Column:
    """The source file's ratio, recomputed to its four decimals."""
    return F.expr(f"round({ratio(amount, income)}, 4)")
