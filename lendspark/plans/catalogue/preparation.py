"""Derived features, splits, folds, imputation, scaling, encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendspark.functions.features import DERIVED, add_derived_features, loan_percent_income
from lendspark.operators import relational as rel
from lendspark.operators import split as spl
from lendspark.plans import training as tr
from lendspark.plans.catalogue.base import APP, BASE, SCORED, SPLIT, applications, query, scored
from lendspark.plans.catalogue.tables import raw_file
from lendspark.schemas import HOME_OWNERSHIP, TARGET
from lendspark.session import stored


@query(f"""
WITH {APP}
SELECT application_id,
  round(CASE WHEN income > 0 THEN loan_amount / income END, 6) AS loan_to_income,
  round(CASE WHEN income > 0 THEN total_debt / income END, 6) AS debt_to_income,
  round(CASE WHEN employment_years IS NOT NULL THEN income / greatest(employment_years, 1) END, 6)
    AS income_per_employment_year,
  round(credit_history_years / greatest(age, 1), 6) AS credit_age_ratio,
  round(late_payments / greatest(credit_history_years, 1), 6) AS late_payment_rate
FROM app
""")
def derived_features(spark, sf_dir):
    rows = add_derived_features(applications(spark, sf_dir))
    return rows.select("application_id", *[F.round(c, 6).alias(c) for c in DERIVED])


@query(f"""
WITH {BASE}
SELECT application_id, round(CASE WHEN income > 0 THEN loan_amount / income END, 4) AS recomputed
FROM base WHERE application_id % 13 = 0 AND income > 0
""")
def percent_income_check(spark, sf_dir):
    """Rows whose stored ratio differs from the recomputed one (every 13th is spoiled)."""
    raw = raw_file(spark, sf_dir)
    rows = raw.withColumn("recomputed", loan_percent_income("loan_amnt", "person_income"))
    off = F.abs(F.col("recomputed") - F.col("loan_percent_income")) > 0.00005
    return rows.where(off).select("application_id", "recomputed")


def _split_rows(spark, sf_dir, *columns):
    """Key, target, ``columns`` and part of the scored rows, which are written once: finding the cuts reads them too."""
    rows = scored(spark, sf_dir).select("application_id", TARGET, *columns)
    return spl.stratified_split(stored(rows, "scored"), "application_id")


@query(f"WITH {SPLIT} SELECT application_id, loan_status, split FROM parted")
def stratified_split(spark, sf_dir):
    rows = _split_rows(spark, sf_dir)
    return rows.select("application_id", "loan_status", "split")


@query(f"""
WITH {BASE}, ordered AS (
  SELECT application_ts, row_number() OVER (ORDER BY application_ts) AS rn, count(*) OVER () AS n FROM base),
cuts AS (SELECT max(application_ts) FILTER (WHERE rn = 70 * n // 100) AS a,
                max(application_ts) FILTER (WHERE rn = 85 * n // 100) AS b FROM ordered)
SELECT application_id, CASE WHEN application_ts <= a THEN 'train' WHEN application_ts <= b THEN 'validation'
                            ELSE 'test' END AS split
FROM base, cuts
""")
def time_split(spark, sf_dir):
    rows = spl.time_split(applications(spark, sf_dir, history=False), "application_ts")
    return rows.select("application_id", "split")


FOLDS = (
    SCORED
    + """,
folds AS (
  SELECT *, CASE WHEN rn <= 20 * class_n // 100 THEN 0 WHEN rn <= 40 * class_n // 100 THEN 1
                 WHEN rn <= 60 * class_n // 100 THEN 2 WHEN rn <= 80 * class_n // 100 THEN 3 ELSE 4 END AS fold
  FROM (SELECT *, row_number() OVER (PARTITION BY loan_status ORDER BY md5('42:' || application_id)) AS rn,
          count(*) OVER (PARTITION BY loan_status) AS class_n FROM scored)
)"""
)


@query(f"WITH {FOLDS} SELECT application_id, fold FROM folds")
def fold_ids(spark, sf_dir):
    rows = stored(scored(spark, sf_dir).select("application_id", TARGET), "scored")
    return spl.stratified_folds(rows, "application_id").select("application_id", "fold")


@query(f"""
WITH {SPLIT}, med AS (
  SELECT quantile_cont(employment_years, 0.5) AS e, quantile_cont(interest_rate, 0.5) AS i FROM parted
  WHERE split = 'train')
SELECT application_id, split, coalesce(employment_years, e) AS employment_years,
  coalesce(interest_rate, i) AS interest_rate,
  CAST(employment_years IS NULL AS INTEGER) AS employment_years_was_missing,
  CAST(interest_rate IS NULL AS INTEGER) AS interest_rate_was_missing
FROM parted, med
""")
def impute_with_flags(spark, sf_dir):
    """Medians of the training part fill all parts."""
    columns = ("employment_years", "interest_rate")
    rows = stored(_split_rows(spark, sf_dir, *columns), "split")
    medians = tr.fit_medians(rows.where(F.col("split") == "train"), columns)
    return tr.impute_with_flags(rows, medians).select(
        "application_id", "split", *columns, *[f"{c}_was_missing" for c in columns]
    )


@query(f"""
WITH {SPLIT}, s AS (
  SELECT avg(income) AS mi, stddev_samp(income) AS si, avg(loan_amount) AS ml, stddev_samp(loan_amount) AS sl
  FROM parted WHERE split = 'train')
SELECT application_id, round((income - mi) / si, 6) AS income_scaled,
  round((loan_amount - ml) / sl, 6) AS loan_amount_scaled
FROM parted, s
""")
def scale_standard(spark, sf_dir):
    rows = stored(_split_rows(spark, sf_dir, "income", "loan_amount"), "split")
    scale = tr.fit_scale(rows.where(F.col("split") == "train"), ("income", "loan_amount"))
    return tr.scale_standard(rows, scale).select(
        "application_id",
        F.round("income_scaled", 6).alias("income_scaled"),
        F.round("loan_amount_scaled", 6).alias("loan_amount_scaled"),
    )


@query(f"""
WITH {BASE}
SELECT application_id,
  CAST(home_ownership = 'RENT' AS INTEGER) AS home_ownership_rent,
  CAST(home_ownership = 'OWN' AS INTEGER) AS home_ownership_own,
  CAST(home_ownership = 'MORTGAGE' AS INTEGER) AS home_ownership_mortgage,
  CAST(home_ownership = 'OTHER' AS INTEGER) AS home_ownership_other
FROM base
""")
def one_hot(spark, sf_dir):
    rows = tr.one_hot(applications(spark, sf_dir, history=False), "home_ownership", HOME_OWNERSHIP)
    return rows.select("application_id", *[f"home_ownership_{v.lower()}" for v in HOME_OWNERSHIP])


@query(f"""
WITH {SPLIT}, t AS (SELECT * FROM parted WHERE split = 'train'),
k AS (SELECT count(*) FILTER (WHERE loan_status = 0) // count(*) FILTER (WHERE loan_status = 1) AS times FROM t)
SELECT application_id, loan_status, CAST(c.copy AS INTEGER) AS copy FROM t, k, range(1, 200) AS c(copy)
WHERE c.copy <= CASE WHEN loan_status = 1 THEN greatest(times, 1) ELSE 1 END
""")
def oversample(spark, sf_dir):
    rows = stored(_split_rows(spark, sf_dir), "split")
    more = spl.oversample(rows.where(F.col("split") == "train"))
    return more.select("application_id", "loan_status", "copy")


@query(f"""
WITH {BASE} SELECT 'kept' AS what, count(*) AS n FROM base
""")
def forbidden_features(spark, sf_dir):
    """The target and all outcome columns are gone from a feature table."""
    a = rel.drop_forbidden(applications(spark, sf_dir, history=False))
    tr.preprocessing()  # raises if a listed feature were forbidden
    left = [c for c in a.columns if c in tr.FORBIDDEN_FEATURES]
    return a.agg(F.lit("kept" if not left else "leaked").alias("what"), F.count(F.lit(1)).alias("n"))
