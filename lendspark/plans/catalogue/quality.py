"""Data quality profile and class balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendspark.operators import profile as prof
from lendspark.plans.catalogue.base import APP, BASE, SCORED, applications, query, scored, settled, settled_sql, table
from lendspark.schemas import HOME_OWNERSHIP, LOAN_INTENT
from lendspark.session import stored

_ALL = (
    "application_id customer_id application_ts age income employment_years home_ownership loan_amount "
    "interest_rate term_months loan_intent loan_grade credit_history_years credit_utilization "
    "previous_defaults loan_status"
).split()
_NUMERIC = ("income", "loan_amount", "interest_rate", "employment_years", "credit_utilization")
_DISTINCT = ("customer_id", "age", "home_ownership", "loan_amount", "interest_rate", "loan_intent", "term_months")
_CATEGORICAL = ("home_ownership", "loan_intent", "loan_grade")


@query(f"WITH {BASE} SELECT count(*) AS n_rows, {len(_ALL)} AS n_columns FROM base")
def row_counts(spark, sf_dir):
    return prof.row_counts(applications(spark, sf_dir, history=False))


@query(f"WITH {BASE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    f"round(100.0::DOUBLE * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS pct_null FROM base"
    for c in _ALL
))
def null_profile(spark, sf_dir):
    return prof.null_profile(applications(spark, sf_dir, history=False))


#: lineitem with some rows twice and some three times.
_COPIED = """
copied AS (
  SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 7 = 3
  UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 21 = 3
)"""


def _copied(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rows.unionByName(rows.where("l_orderkey % 7 = 3")).unionByName(rows.where("l_orderkey % 21 = 3"))


@query(f"""
WITH {_COPIED}
SELECT count(*) FILTER (WHERE n > 1) AS n_sets, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates
FROM (SELECT *, count(*) AS n FROM copied GROUP BY ALL)
""")
def duplicates(spark, sf_dir):
    """Rows of lineitem that repeat in every column; copies are added, since the table has none."""
    return prof.duplicates(_copied(spark, sf_dir))


@query(f"""
WITH {_COPIED}
SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM (SELECT DISTINCT * FROM copied) GROUP BY l_returnflag
""")
def without_duplicates(spark, sf_dir):
    """The same table with one of each set of equal rows."""
    price = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price")
    return prof.without_duplicates(_copied(spark, sf_dir)).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), price)


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def one_per_key(spark, sf_dir):
    """The newest order of each customer."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return prof.one_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(f"WITH {BASE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM base" for c in _DISTINCT
))
def distinct_counts(spark, sf_dir):
    return prof.distinct_counts(applications(spark, sf_dir, history=False), _DISTINCT)


@query(f"WITH {BASE} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, {settled_sql(f"min({c})", 4)} AS "min",
      {settled_sql(f"quantile_cont({c}, 0.25)", 4)} AS q25, {settled_sql(f"quantile_cont({c}, 0.5)", 4)} AS median,
      {settled_sql(f"quantile_cont({c}, 0.75)", 4)} AS q75, {settled_sql(f"max({c})", 4)} AS "max",
      {settled_sql(f"avg({c})", 4)} AS mean, {settled_sql(f"stddev_samp({c})", 4)} AS stddev FROM base"""
    for c in _NUMERIC
))
def numeric_profile(spark, sf_dir):
    return settled(prof.numeric_profile(applications(spark, sf_dir, history=False), _NUMERIC), 4)


@query(f"WITH {BASE} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {c} AS "value", count(*) AS n,
      round(count(*) / (SELECT count(*) FROM base), 6) AS share FROM base GROUP BY {c}"""
    for c in _CATEGORICAL
))
def categorical_profile(spark, sf_dir):
    return prof.categorical_profile(applications(spark, sf_dir, history=False), _CATEGORICAL)


@query(f"""
WITH {BASE}
SELECT loan_status, count(*) AS n, round(count(*) / (SELECT count(*) FROM base), 6) AS share FROM base
GROUP BY loan_status
""")
def target_distribution(spark, sf_dir):
    return prof.target_distribution(applications(spark, sf_dir, history=False))


@query(f"WITH {APP} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {settled_sql("lo", 4)} AS "lower", {settled_sql("hi", 4)} AS "upper",
      count(*) FILTER (WHERE {c} < lo) AS n_low, count(*) FILTER (WHERE {c} > hi) AS n_high
    FROM app, (SELECT q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM (
      SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM app)) GROUP BY lo, hi"""
    for c in ("income", "loan_amount", "late_payments", "total_debt")
))
def outliers_iqr(spark, sf_dir):
    columns = ("income", "loan_amount", "late_payments", "total_debt")
    rows = stored(applications(spark, sf_dir).select(*columns), "applications")
    return settled(prof.outliers_iqr(rows, columns), 4)


_CORR = ("income", "loan_amount", "interest_rate", "credit_utilization", "late_payments", "loan_status")


@query(f"WITH {APP} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(corr({c}, loan_status), 6) AS "corr",
      coalesce(abs(corr({c}, loan_status)) >= 0.9, false) AS suspicious FROM app"""
    for c in _CORR
))
def leakage_corr(spark, sf_dir):
    """The target itself is among the columns, so one alarm is expected."""
    return prof.leakage_corr(applications(spark, sf_dir), _CORR)


@query(f"""
WITH {BASE}
SELECT 'home_ownership' AS "column", home_ownership AS "value", count(*) AS n FROM base
WHERE home_ownership NOT IN ('RENT', 'OWN', 'MORTGAGE', 'OTHER') GROUP BY home_ownership
UNION ALL
SELECT 'loan_intent', loan_intent, count(*) FROM base
WHERE loan_intent NOT IN ('PERSONAL', 'EDUCATION', 'MEDICAL', 'VENTURE', 'HOMEIMPROVEMENT', 'DEBTCONSOLIDATION')
GROUP BY loan_intent
""")
def invalid_categories(spark, sf_dir):
    return prof.invalid_categories(
        applications(spark, sf_dir, history=False),
        {"home_ownership": HOME_OWNERSHIP, "loan_intent": LOAN_INTENT},
    )


@query(f"""
WITH {BASE}
SELECT round(avg(loan_status), 6) AS positive_rate, round(avg(1 - loan_status), 6) AS negative_rate,
  round(CAST(sum(1 - loan_status) AS DOUBLE) / sum(loan_status), 6) AS class_ratio FROM base
""")
def class_balance(spark, sf_dir):
    return prof.class_balance(applications(spark, sf_dir, history=False))


@query(f"""
WITH {SCORED}, w AS (
  SELECT CAST(sum(1 - loan_status) AS DOUBLE) / sum(loan_status) AS ratio FROM scored)
SELECT application_id, round(CASE WHEN loan_status = 1 THEN ratio ELSE 1 END, 6) AS weight FROM scored, w
""")
def class_weights(spark, sf_dir):
    rows = prof.add_class_weight(scored(spark, sf_dir))
    return rows.select("application_id", F.round("weight", 6).alias("weight"))
