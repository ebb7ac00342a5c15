"""Monitoring over stored predictions and applications."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendspark.operators import monitor as mon
from lendspark.operators.validate import REQUEST
from lendspark.plans.catalogue.base import (
    APP,
    BASE,
    PREDICTIONS,
    SCORED,
    applications,
    predictions,
    query,
    scored,
    settled,
    settled_sql,
)
from lendspark.plans.catalogue.evaluation import METRICS, grouped, shown
from lendspark.plans.scoring import with_risk

_CUT = "1998-01-01 00:00:00"


def _before_cut():
    return F.col("application_ts") < F.lit(_CUT).cast("timestamp_ntz")


@query(f"""
WITH {PREDICTIONS}
SELECT prediction_version, strftime(application_ts, '%Y-%m-%d') AS "day", count(*) AS n FROM predictions GROUP BY ALL
""")
def prediction_counts(spark, sf_dir):
    rows = mon.prediction_counts(predictions(spark, sf_dir), "prediction_version", "application_ts")
    return rows.withColumn("day", F.col("day").cast("string"))


@query(f"""
WITH {PREDICTIONS}
SELECT prediction_version, count(latency_ms) AS n, {settled_sql("avg(CAST(latency_ms AS DOUBLE))")} AS mean_ms,
  {settled_sql("max(CAST(latency_ms AS DOUBLE))")} AS max_ms,
  {settled_sql("quantile_cont(CAST(latency_ms AS DOUBLE), 0.95)")} AS p95_ms
FROM predictions GROUP BY prediction_version
""")
def latency_stats(spark, sf_dir):
    return settled(mon.latency_stats(predictions(spark, sf_dir), ["prediction_version"]))


@query(f"""
WITH {APP}, n AS (
  SELECT CAST(income < 0 AS INTEGER) AS r, CAST(home_ownership = 'PALACE' AS INTEGER) AS c,
    CAST(employment_years IS NULL AS INTEGER) + CAST(interest_rate IS NULL AS INTEGER) AS m FROM app)
SELECT 'range' AS kind, count(*) FILTER (WHERE r > 0) AS n_rows, CAST(sum(r) AS BIGINT) AS n_violations FROM n
UNION ALL SELECT 'category', count(*) FILTER (WHERE c > 0), CAST(sum(c) AS BIGINT) FROM n
UNION ALL SELECT 'missing', count(*) FILTER (WHERE m > 0), CAST(sum(m) AS BIGINT) FROM n
""")
def error_counts(spark, sf_dir):
    return mon.error_counts(applications(spark, sf_dir), REQUEST)


_PSI_NUMERIC = ("loan_amount", "income")


def _psi_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", round(sum((a - e) * ln(a / e)), 6) AS psi FROM (
  SELECT greatest(n1 / sum(n1) OVER (), 1e-6) AS e, greatest(n2 / sum(n2) OVER (), 1e-6) AS a FROM (
    SELECT count(*) FILTER (WHERE ref) AS n1, count(*) FILTER (WHERE NOT ref) AS n2 FROM (
      SELECT application_ts < TIMESTAMP '{_CUT}' AS ref,
        CASE WHEN {c} <= q[1] THEN 0 WHEN {c} <= q[2] THEN 1 WHEN {c} <= q[3] THEN 2 WHEN {c} <= q[4] THEN 3
             WHEN {c} <= q[5] THEN 4 ELSE 5 END AS bin
      FROM base, (SELECT quantile_cont({c}, [0.1, 0.25, 0.5, 0.75, 0.9]) AS q FROM base
                  WHERE application_ts < TIMESTAMP '{_CUT}'))
    GROUP BY bin))"""


@query(f"WITH {BASE} " + " UNION ALL ".join(_psi_sql(c) for c in _PSI_NUMERIC))
def psi_numeric(spark, sf_dir):
    a = applications(spark, sf_dir, history=False)
    out = None
    for c in _PSI_NUMERIC:
        one = mon.psi_numeric(a, c, _before_cut())
        out = one if out is None else out.unionByName(one)
    return out


_PSI_CATEGORICAL = ("home_ownership", "loan_intent", "loan_grade")


@query(f"WITH {BASE} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(sum((a - e) * ln(a / e)), 6) AS psi FROM (
      SELECT greatest(n1 / sum(n1) OVER (), 1e-6) AS e, greatest(n2 / sum(n2) OVER (), 1e-6) AS a FROM (
        SELECT count(*) FILTER (WHERE application_ts < TIMESTAMP '{_CUT}') AS n1,
          count(*) FILTER (WHERE application_ts >= TIMESTAMP '{_CUT}') AS n2 FROM base GROUP BY {c}))"""
    for c in _PSI_CATEGORICAL
))
def psi_categorical(spark, sf_dir):
    return mon.psi_categorical(applications(spark, sf_dir, history=False), _PSI_CATEGORICAL, _before_cut())


@query(f"""
WITH {SCORED}, found AS (
  SELECT strftime(application_ts, '%Y-%m') AS "month", risk_level, count(*) AS n FROM risk GROUP BY ALL),
months AS (SELECT strftime(unnest(generate_series(min(date_trunc('month', application_ts)), max(date_trunc('month', application_ts)), INTERVAL 1 MONTH)), '%Y-%m') AS "month" FROM risk),
c AS (SELECT "month", risk_level, coalesce(n, 0) AS n
      FROM months CROSS JOIN (SELECT unnest(['LOW', 'MEDIUM', 'HIGH']) AS risk_level) LEFT JOIN found USING ("month", risk_level)),
s AS (SELECT *, n / nullif(sum(n) OVER (PARTITION BY "month"), 0) AS share FROM c)
SELECT "month", risk_level, n, round(share, 6) AS share,
  round(share - lag(share) OVER (PARTITION BY risk_level ORDER BY "month"), 6) AS change
FROM s
""")
def prediction_drift(spark, sf_dir):
    return mon.prediction_drift(with_risk(scored(spark, sf_dir)), "application_ts")


@query(f"""
WITH {SCORED}, by_month AS (SELECT strftime(application_ts, '%Y-%m') AS "month", loan_status, p FROM scored),
{grouped('"month"', "by_month")}
SELECT "month", {shown(*METRICS)} FROM ranking JOIN plain USING ("month")
""")
def performance_by_month(spark, sf_dir):
    return settled(mon.performance_by_month(scored(spark, sf_dir), "application_ts"))
