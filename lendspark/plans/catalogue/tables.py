"""Projections, casts, keys and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.functions.scalar import iso_decode, iso_encode, model_identity, stable_id
from lendspark.operators import relational as rel
from lendspark.operators.registry import model_rows
from lendspark.plans.catalogue.base import APP, BASE, METADATA, applications, metadata, query
from lendspark.plans.catalogue.common import EXPLAINED, explained
from lendspark.plans.scoring import nested_response, with_risk
from lendspark.schemas import COMMON_SHAPE, EXPLANATION, FEATURES
from lendspark.sources.readers import decode, encode, explode_batch


def raw_file(spark, sf_dir):
    """Applications in the shape of the raw file (inverse of the renames)."""
    a = applications(spark, sf_dir, history=False)
    flag = F.when(F.col("application_id") % 50 == 49, "U").when(F.col("previous_defaults") == 1, "Y")
    share = F.round(F.try_divide("loan_amount", F.when(F.col("income") > 0, F.col("income"))), 4)
    off = F.when(F.col("application_id") % 13 == 0, share + 0.5).otherwise(share)
    return a.select(
        "application_id",
        F.col("age").alias("person_age"),
        F.col("income").alias("person_income"),
        F.col("home_ownership").alias("person_home_ownership"),
        F.col("employment_years").alias("person_emp_length"),
        "loan_intent",
        "loan_grade",
        F.col("loan_amount").alias("loan_amnt"),
        F.col("interest_rate").alias("loan_int_rate"),
        "loan_status",
        off.alias("loan_percent_income"),
        flag.otherwise("N").alias("cb_person_default_on_file"),
        F.col("credit_history_years").cast("int").alias("cb_person_cred_hist_length"),
    )


@query(f"""
WITH {APP}
SELECT application_id, CAST(item AS INTEGER) AS item, age, income, employment_years, home_ownership,
  loan_amount * (1 + item) AS loan_amount, interest_rate, term_months, loan_intent,
  CAST(credit_history_years AS INTEGER) AS credit_history_years, late_payments, credit_utilization
FROM app, (VALUES (0), (1)) AS items(item)
""")
def json_batch_explode(spark, sf_dir):
    """Each application arrives in a JSON array of two, with a field nobody declared."""
    a = applications(spark, sf_dir)
    own = [F.col(c) for c in FEATURES if c != "loan_amount"]
    items = F.array(
        *[
            F.struct(*own, (F.col("loan_amount") * m).alias("loan_amount"), F.lit("?").alias("note"))
            for m in (1, 2)
        ]
    )
    batches = a.select("application_id", encode(items).alias("payload"))
    return explode_batch(batches, "payload").drop("previous_defaults", "active_credit_lines")


@query(f"""
WITH {EXPLAINED}
SELECT application_id, feature, impact,
  CASE WHEN impact >= 0 THEN 'positive' ELSE 'negative' END AS direction,
  strftime(application_ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_text, application_ts AS ts_back
FROM impacts
""")
def json_round_trip(spark, sf_dir):
    rows = explained(spark, sf_dir)
    texts = rows.select(
        "application_id", encode(F.col("explanation")).alias("j"), iso_encode("application_ts").alias("ts_text")
    )
    return texts.select(
        "application_id", F.inline(decode("j", EXPLANATION)), "ts_text"
    ).withColumn("ts_back", iso_decode("ts_text"))


@query(f"""
WITH {BASE}
SELECT application_id, loan_grade, loan_status, age, income, employment_years, home_ownership, loan_amount,
  interest_rate, loan_intent, CAST(credit_history_years AS INTEGER) AS credit_history_years,
  CASE WHEN application_id % 50 = 49 THEN NULL ELSE previous_defaults END AS previous_defaults
FROM base
""")
def rename_source_to_api(spark, sf_dir):
    return rel.source_to_api(raw_file(spark, sf_dir)).drop("loan_percent_income")


@query(f"""
WITH {BASE}
SELECT application_id, loan_amount AS amount, loan_intent AS purpose, loan_grade AS grade FROM base
""")
def rename_to_canonical(spark, sf_dir):
    a = applications(spark, sf_dir, history=False)
    return rel.api_to_table(a.select("application_id", "loan_amount", "loan_intent", "loan_grade"))


@query(f"""
WITH {BASE}, newest AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY application_ts DESC, application_id DESC) AS rn
  FROM base)
SELECT customer_id AS id, age, income, home_ownership, employment_years FROM newest WHERE rn = 1
""")
def normalise_customers(spark, sf_dir):
    t = rel.normalise_customers(applications(spark, sf_dir, history=False))
    return t.withColumns(
        {c: F.col(c).cast("double") for c in ("income", "employment_years")}
    )


@query(f"""
WITH {BASE}
SELECT application_id AS id, customer_id, loan_amount AS amount, interest_rate, term_months,
  loan_intent AS purpose, loan_grade AS grade, loan_status,
  CAST(TRY_CAST(round(CASE WHEN income > 0 THEN loan_amount / income END, 4) AS DECIMAL(5,4)) AS DOUBLE)
    AS loan_percent_income
FROM base
""")
def normalise_loans(spark, sf_dir):
    t = rel.normalise_loans(applications(spark, sf_dir, history=False))
    return t.withColumns(
        {c: F.col(c).cast("double") for c in ("amount", "interest_rate", "loan_percent_income")}
    )


@query(f"""
WITH {APP}, newest AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY application_ts DESC, application_id DESC) AS rn
  FROM app)
SELECT sha256('history|' || customer_id) AS id, customer_id,
  CAST(credit_history_years AS INTEGER) AS credit_history_years, previous_defaults, late_payments,
  credit_utilization, active_credit_lines
FROM newest WHERE rn = 1
""")
def normalise_credit_histories(spark, sf_dir):
    t = rel.normalise_credit_histories(applications(spark, sf_dir))
    return t.withColumn("credit_utilization", F.col("credit_utilization").cast("double"))


@query(f"""
WITH {APP}
SELECT application_id, age, income, employment_years, home_ownership, loan_amount, interest_rate, term_months,
  loan_intent, CAST(credit_history_years AS INTEGER) AS credit_history_years, late_payments, previous_defaults,
  credit_utilization, active_credit_lines
FROM app
""")
def feature_frame(spark, sf_dir):
    a = rel.drop_forbidden(applications(spark, sf_dir))
    return rel.feature_frame(a, extra=["application_id"])


@query("""
SELECT o_orderkey AS application_id, o_custkey AS customer_id,
  sha256(o_custkey || '|' || o_orderkey) AS id
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def surrogate_key(spark, sf_dir):
    a = applications(spark, sf_dir, history=False).select("application_id", "customer_id")
    return a.withColumn("id", stable_id("customer_id", "application_id"))


@query(f"""
WITH {EXPLAINED}, per_row AS (
  SELECT application_id, count(*) AS n_contributions,
    arg_min(feature, (-abs(impact), feature)) AS first_feature,
    arg_min(impact, (-abs(impact), feature)) AS first_impact
  FROM impacts GROUP BY application_id)
SELECT application_id, p AS default_probability, risk_score, risk_level, 'scorecard' AS model_name,
  '1.0.0' AS model_version, CAST(n_contributions AS INTEGER) AS n_contributions, first_feature, first_impact
FROM risk JOIN per_row USING (application_id)
""")
def nested_response_shape(spark, sf_dir):
    r = nested_response(with_risk(explained(spark, sf_dir)), "scorecard", "1.0.0")
    return r.select(
        "application_id",
        "response.default_probability",
        "response.risk_score",
        "response.risk_level",
        F.col("response.model.name").alias("model_name"),
        F.col("response.model.version").alias("model_version"),
        F.size("response.explanation").alias("n_contributions"),
        F.get("response.explanation", F.lit(0))["feature"].alias("first_feature"),
        F.get("response.explanation", F.lit(0))["impact"].alias("first_impact"),
    )


@query(f"""
WITH {BASE}
SELECT application_id, age, income, employment_years, home_ownership, loan_amount, interest_rate, term_months,
  loan_intent, loan_grade, CAST(credit_history_years AS INTEGER) AS credit_history_years, credit_utilization,
  loan_status, previous_defaults AS previous_default, 'loan_percent_income,late_payments,active_credit_lines' AS empty_columns
FROM base
""")
def first_schema(spark, sf_dir):
    """The 16-column shape; what the table lacks is NULL there and named in the last column."""
    a = applications(spark, sf_dir, history=False)
    absent = [c for c in COMMON_SHAPE.fieldNames() if c not in a.columns and c != "previous_default"]
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in absent])
    shape = T.StructType([a.schema["application_id"], *COMMON_SHAPE.fields])
    return rel.to_shape(a, shape).withColumn("empty_columns", names).drop(*absent)


@query(f"""
WITH {BASE}
SELECT application_id,
  CASE WHEN application_id % 10 IN (1, 2) THEN NULL ELSE age END AS age,
  CASE WHEN application_id % 7 = 3 THEN NULL ELSE income END AS income,
  home_ownership,
  concat_ws(',', CASE WHEN application_id % 10 IN (1, 2) THEN 'age' END,
                 CASE WHEN application_id % 7 = 3 THEN 'income' END) AS unconverted
FROM base
""")
def lenient_cast(spark, sf_dir):
    """Text input: whole numbers in text convert, so does ``34.0``; ``34.5`` is no whole number."""
    key = F.col("application_id") % 10
    text = applications(spark, sf_dir, history=False).select(
        "application_id",
        F.when(key == 0, F.concat(F.col("age").cast("string"), F.lit(".0")))
        .when(key == 1, "unknown")
        .when(key == 2, F.concat(F.col("age").cast("string"), F.lit(".5")))
        .otherwise(F.col("age").cast("string"))
        .alias("age"),
        F.when(F.col("application_id") % 7 == 3, "n/a").otherwise(F.col("income").cast("string")).alias("income"),
        "home_ownership",
    )
    return rel.lenient_cast(text).withColumn("unconverted", F.concat_ws(",", "unconverted"))


@query(f"""
WITH {METADATA}
SELECT sha256(name || '|' || version) AS id, name, version, algorithm, training_dataset, feature_version,
  roc_auc, pr_auc, brier_score, f1 IS NULL AS f1_absent, trained_at, name || ':v' || version AS identity
FROM metadata
""")
def model_row(spark, sf_dir):
    rows = model_rows(metadata(spark, sf_dir), "models/scorecard")
    return rows.withColumns(
        {"f1_absent": F.col("f1").isNull(), "identity": model_identity("name", "version")}
    ).drop("f1", "artifact_path", "is_active")


@query("""
SELECT c_custkey AS id, CAST(18 + c_custkey % 63 AS INTEGER) AS age, round(c_acctbal * 1200, 0) AS income,
  CASE WHEN c_custkey % 29 <> 0 THEN CAST(c_custkey % 41 AS DOUBLE) / 2 END AS employment_years,
  CASE WHEN c_custkey % 97 = 0 THEN 'PALACE' WHEN c_mktsegment = 'BUILDING' THEN 'OWN'
       WHEN c_mktsegment = 'FURNITURE' THEN 'MORTGAGE' WHEN c_mktsegment = 'MACHINERY' THEN 'OTHER'
       ELSE 'RENT' END AS home_ownership
FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
""")
def customer_read(spark, sf_dir):
    return rel.customer_read(rel.normalise_customers(applications(spark, sf_dir, history=False)))
