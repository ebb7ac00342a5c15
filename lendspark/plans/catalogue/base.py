"""Query registry, and the SQL form of the views for side-by-side checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.functions.scalar import stable_id
from lendspark.sources.views import applications, scored, table  # noqa: F401 (used by siblings)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its own name, with its SQL if there is one."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return add


def settled(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round all double columns for comparison.

    Sums of doubles may differ in the last bit between engines. Where the exact
    value lies on a rounding tie (a mean of cents, say) that bit would decide, so
    both sides first move the value by the same tiny share.
    """
    return df.selectExpr(
        *[
            f"round(`{c}` * (1D + 1e-12D), {digits}) AS `{c}`" if t == "double" else f"`{c}`"
            for c, t in df.dtypes
        ]
    )


def settled_sql(expr: str, digits: int = 6) -> str:
    return f"round(({expr}) * (1::DOUBLE + 1e-12::DOUBLE), {digits})"


BASE = """
returned AS (
  SELECT l_orderkey, count(*) AS n_returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey
),
base AS (
  SELECT o_orderkey AS application_id, o_custkey AS customer_id, o_orderdate AS application_ts,
    CAST(18 + c_custkey % 63 AS INTEGER) AS age,
    round(c_acctbal * 1200, 0) AS income,
    CASE WHEN c_custkey % 29 <> 0 THEN CAST(c_custkey % 41 AS DOUBLE) / 2 END AS employment_years,
    CASE WHEN c_custkey % 97 = 0 THEN 'PALACE' WHEN c_mktsegment = 'BUILDING' THEN 'OWN'
         WHEN c_mktsegment = 'FURNITURE' THEN 'MORTGAGE' WHEN c_mktsegment = 'MACHINERY' THEN 'OTHER'
         ELSE 'RENT' END AS home_ownership,
    o_totalprice AS loan_amount,
    CASE WHEN o_orderkey % 37 <> 0 THEN 5 + CAST(o_orderkey % 180 AS DOUBLE) / 10 END AS interest_rate,
    CASE o_orderkey % 3 WHEN 0 THEN 36 WHEN 1 THEN 60 END AS term_months,
    CASE o_orderkey % 6 WHEN 0 THEN 'PERSONAL' WHEN 1 THEN 'EDUCATION' WHEN 2 THEN 'MEDICAL'
         WHEN 3 THEN 'VENTURE' WHEN 4 THEN 'HOMEIMPROVEMENT' ELSE 'DEBTCONSOLIDATION' END AS loan_intent,
    substr('ABCDEFG', CAST(1 + o_orderkey % 7 AS INTEGER), 1) AS loan_grade,
    1 + c_custkey % 30 AS credit_history_years,
    CAST(o_orderkey % 101 AS DOUBLE) / 100 AS credit_utilization,
    CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS previous_defaults,
    CASE WHEN coalesce(n_returned, 0) >= 3
           OR (o_totalprice > 0.05::DOUBLE * greatest(c_acctbal * 1200, 1) AND o_orderkey % 5 < 2)
         THEN 1 ELSE 0 END AS loan_status,
    o_orderstatus = 'O' AS is_open
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN returned ON o_orderkey = l_orderkey
)"""

APP = BASE + """,
app AS (
  SELECT * EXCLUDE (is_open),
    CAST(coalesce(sum(loan_status) OVER w, 0) AS INTEGER) AS late_payments,
    CAST(coalesce(sum(CASE WHEN is_open THEN 1 ELSE 0 END) OVER w, 0) AS INTEGER) AS active_credit_lines,
    CAST(coalesce(sum(CASE WHEN is_open THEN CAST(loan_amount AS DECIMAL(14,2)) END) OVER w, 0) AS DOUBLE)
      AS total_debt
  FROM base
  WINDOW w AS (PARTITION BY customer_id ORDER BY application_ts
               RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)
)"""

#: A row passes the training rules.
TRAINING_OK = """
age > 0 AND age < 120 AND income >= 0 AND coalesce(employment_years >= 0, true)
AND home_ownership IN ('RENT', 'OWN', 'MORTGAGE', 'OTHER') AND loan_amount > 0
AND coalesce(interest_rate >= 0, true) AND coalesce(term_months > 0, true)
AND loan_intent IN ('PERSONAL', 'EDUCATION', 'MEDICAL', 'VENTURE', 'HOMEIMPROVEMENT', 'DEBTCONSOLIDATION')
AND credit_history_years >= 0 AND coalesce(previous_defaults >= 0, true)
AND coalesce(credit_utilization BETWEEN 0 AND 1, true)"""
REQUEST_OK = TRAINING_OK + " AND employment_years IS NOT NULL AND interest_rate IS NOT NULL"

SCORED = APP + f""",
inputs AS (
  SELECT *,
    least(coalesce(CASE WHEN income > 0 THEN loan_amount / income END, 1), 1) AS x_loan_to_income,
    coalesce(interest_rate, 11) AS x_interest_rate,
    CAST(late_payments AS DOUBLE) AS x_late_payments,
    credit_utilization AS x_credit_utilization
  FROM app WHERE {TRAINING_OK}
),
scored AS (
  SELECT *, round(1 / (1 + exp(-(-2.5::DOUBLE + 1.5::DOUBLE * x_loan_to_income
      + 0.05::DOUBLE * (x_interest_rate - 11) + 0.2::DOUBLE * x_late_payments
      + 0.5::DOUBLE * x_credit_utilization))), 2) AS p
  FROM inputs
),
risk AS (
  SELECT *, CAST(round_even(p * 100, 0) AS INTEGER) AS risk_score,
    CASE WHEN round_even(p * 100, 0) <= 30 THEN 'LOW' WHEN round_even(p * 100, 0) <= 70 THEN 'MEDIUM'
         ELSE 'HIGH' END AS risk_level
  FROM scored
)"""

SPLIT = SCORED + """,
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY loan_status ORDER BY md5('42:' || application_id)) AS rn,
    count(*) OVER (PARTITION BY loan_status) AS class_n
  FROM scored
),
parted AS (
  SELECT *, CASE WHEN rn <= 70 * class_n // 100 THEN 'train' WHEN rn <= 85 * class_n // 100 THEN 'validation'
                 ELSE 'test' END AS split
  FROM ordered
)"""


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifact metadata rows, one per part: 40 model names with many versions each."""
    key = F.col("p_partkey")
    pairs = F.array(
        F.struct(F.lit("roc_auc").alias("k"), (F.col("p_size") / 100.0 + 0.4).alias("v")),
        F.when(key % 3 == 0, F.struct(F.lit("pr_auc").alias("k"), (F.col("p_size") / 200.0).alias("v"))),
        F.struct(F.lit("brier_score").alias("k"), (F.lit(1.0) / (F.col("p_size") + 1)).alias("v")),
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("scorecard-"), (key % 40).cast("string")).alias("name"),
        F.concat(F.floor(key / 40).cast("string"), F.lit(".0.0")).alias("version"),
        F.col("p_type").alias("algorithm"),
        F.col("p_brand").alias("dataset_version"),
        F.lit("v1").alias("feature_version"),
        F.map_from_entries(F.array_compact(pairs)).alias("metrics"),
        F.timestamp_add("HOUR", key * 7 % 100000, F.lit("2015-01-01 00:00:00").cast("timestamp_ntz")).alias(
            "trained_at"
        ),
        key.alias("part"),
    )


METADATA = """
metadata AS (
  SELECT 'scorecard-' || (p_partkey % 40) AS name, (p_partkey // 40) || '.0.0' AS version,
    p_type AS algorithm, p_brand AS training_dataset, 'v1' AS feature_version,
    p_size / 100.0::DOUBLE + 0.4::DOUBLE AS roc_auc,
    CASE WHEN p_partkey % 3 = 0 THEN p_size / 200.0::DOUBLE END AS pr_auc,
    CAST(NULL AS DOUBLE) AS f1,
    1.0::DOUBLE / (p_size + 1) AS brier_score,
    TIMESTAMP '2015-01-01 00:00:00' + to_hours(p_partkey * 7 % 100000) AS trained_at,
    p_partkey AS part
  FROM part
)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored predictions: every 11th is anonymous, models are referred to by part key."""
    rows = scored(spark, sf_dir)
    key = F.col("application_id")
    return rows.select(
        stable_id(F.lit("prediction"), key).alias("id"),
        F.when(key % 11 != 0, F.col("customer_id")).alias("customer_id"),
        (key % 2600).alias("model_key"),
        "application_id",
        "application_ts",
        F.when(F.year("application_ts") < 1998, "1.0.0").otherwise("1.1.0").alias("prediction_version"),
        (key * 7919 % 100000).alias("_us"),
        F.col("p").alias("default_probability"),
        "loan_status",
    ).select("*", (F.col("_us") / 1000.0).cast("decimal(10,3)").alias("latency_ms")).drop("_us")


PREDICTIONS = SCORED + """,
predictions AS (
  SELECT sha256('prediction|' || application_id) AS id,
    CASE WHEN application_id % 11 <> 0 THEN customer_id END AS customer_id,
    application_id % 2600 AS model_key, application_id, application_ts,
    CASE WHEN year(application_ts) < 1998 THEN '1.0.0' ELSE '1.1.0' END AS prediction_version,
    CAST((application_id * 7919 % 100000) / 1000.0::DOUBLE AS DECIMAL(10,3)) AS latency_ms,
    p AS default_probability, loan_status
  FROM scored
)"""
