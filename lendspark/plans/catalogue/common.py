"""Shared pieces of several queries: the scorecard's explanation."""

from __future__ import annotations

from lendspark.operators import explain
from lendspark.plans.catalogue.base import SCORED, scored
from lendspark.sources.views import SCORECARD, scorecard_inputs

WEIGHTS = {name: weight for name, _, weight in SCORECARD}
INPUTS = [f"x_{name}" for name in WEIGHTS]


def with_impacts(spark, sf_dir):
    """Scored rows with the scorecard's inputs, and the impact expressions."""
    rows = scorecard_inputs(scored(spark, sf_dir))
    means = explain.feature_means(rows, INPUTS)
    return rows, explain.linear_impacts(WEIGHTS, means)


def explained(spark, sf_dir):
    rows, impacts = with_impacts(spark, sf_dir)
    return rows.withColumn("explanation", explain.ranked(impacts)).drop(*INPUTS)


EXPLAINED = SCORED + """,
means AS (
  SELECT avg(x_loan_to_income) AS m1, avg(x_interest_rate) AS m2, avg(x_late_payments) AS m3,
    avg(x_credit_utilization) AS m4 FROM scored
),
impacts AS (
  SELECT application_id, application_ts, 'loan_to_income' AS feature,
    round((x_loan_to_income - m1) * 1.5::DOUBLE, 6) AS impact FROM scored, means
  UNION ALL SELECT application_id, application_ts, 'interest_rate',
    round((x_interest_rate - m2) * 0.05::DOUBLE, 6) FROM scored, means
  UNION ALL SELECT application_id, application_ts, 'late_payments',
    round((x_late_payments - m3) * 0.2::DOUBLE, 6) FROM scored, means
  UNION ALL SELECT application_id, application_ts, 'credit_utilization',
    round((x_credit_utilization - m4) * 0.5::DOUBLE, 6) FROM scored, means
)"""
