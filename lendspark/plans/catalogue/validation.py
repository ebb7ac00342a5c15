"""Row rules, output rules, keys, lookups, quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.functions.scalar import as_uuid, stable_id
from lendspark.operators import registry as reg
from lendspark.operators import relational as rel
from lendspark.operators import validate as val
from lendspark.operators.registry import model_rows
from lendspark.plans.catalogue.base import (
    APP,
    BASE,
    METADATA,
    REQUEST_OK,
    SCORED,
    applications,
    metadata,
    predictions,
    query,
    scored,
    table,
)
from lendspark.plans.catalogue.common import EXPLAINED, explained
from lendspark.plans.scoring import with_risk
from lendspark.schemas import DECIMAL_LIMITS, LENGTH_LIMITS

# (field, kind, SQL condition of a violation), in plain SQL and so independent of the rule table.
_EXTENDED_SQL = [
    ("age", "range", "age <= 0 OR age >= 120"),
    ("income", "range", "income < 0"),
    ("employment_years", "range", "employment_years < 0"),
    ("home_ownership", "category", "home_ownership NOT IN ('RENT', 'OWN', 'MORTGAGE', 'OTHER')"),
    ("loan_amount", "range", "loan_amount <= 0"),
    ("interest_rate", "range", "interest_rate < 0"),
    ("term_months", "range", "term_months <= 0"),
    (
        "loan_intent",
        "category",
        "loan_intent NOT IN ('PERSONAL', 'EDUCATION', 'MEDICAL', 'VENTURE', 'HOMEIMPROVEMENT',"
        " 'DEBTCONSOLIDATION')",
    ),
    ("credit_history_years", "range", "credit_history_years < 0"),
    ("late_payments", "range", "late_payments < 0"),
    ("previous_defaults", "range", "previous_defaults < 0"),
    ("credit_utilization", "range", "credit_utilization < 0 OR credit_utilization > 1"),
    ("active_credit_lines", "range", "active_credit_lines < 0"),
    ("loan_grade", "category", "loan_grade NOT IN ('A', 'B', 'C', 'D', 'E', 'F', 'G')"),
    ("loan_status", "range", "loan_status NOT IN (0, 1)"),
    ("employment_years", "implausible", "employment_years > age - 14"),
]
for _f in (
    "age income employment_years home_ownership loan_amount interest_rate loan_intent credit_history_years"
).split():
    _EXTENDED_SQL.append((_f, "missing", f"{_f} IS NULL"))
VIOLATIONS = " UNION ALL ".join(
    f"SELECT application_id, '{f}' AS field, '{k}' AS kind FROM spoiled WHERE {c}" for f, k, c in _EXTENDED_SQL
)

#: Some values broken on purpose, so that every kind of rule has something to find.
SPOILED = (
    APP
    + """,
spoiled AS (
  SELECT * REPLACE (
    CASE WHEN application_id % 211 = 0 THEN 121 WHEN application_id % 211 = 1 THEN 0
         WHEN application_id % 211 = 2 THEN NULL ELSE age END AS age,
    CASE WHEN application_id % 223 = 0 THEN 0 WHEN application_id % 223 = 1 THEN NULL ELSE loan_amount END
      AS loan_amount,
    CASE WHEN application_id % 227 = 0 THEN -1 ELSE interest_rate END AS interest_rate,
    CASE WHEN application_id % 229 = 0 THEN 0 ELSE term_months END AS term_months,
    CASE WHEN application_id % 233 = 0 THEN 'YACHT' WHEN application_id % 233 = 1 THEN NULL ELSE loan_intent END
      AS loan_intent,
    CASE WHEN application_id % 239 = 0 THEN 1.5 ELSE credit_utilization END AS credit_utilization,
    CASE WHEN application_id % 241 = 0 THEN 'H' ELSE loan_grade END AS loan_grade,
    CASE WHEN application_id % 251 = 0 THEN -1 ELSE late_payments END AS late_payments,
    CASE WHEN application_id % 257 = 0 THEN 2 ELSE loan_status END AS loan_status)
  FROM app
)"""
)


def spoiled(spark, sf_dir):
    a, key = applications(spark, sf_dir), F.col("application_id")

    def put(column, by, *values):
        out = F.when(key % by == 0, values[0])
        for i, v in enumerate(values[1:], start=1):
            out = out.when(key % by == i, F.lit(v))
        return out.otherwise(F.col(column))

    return a.withColumns(
        {
            "age": put("age", 211, F.lit(121), 0, None),
            "loan_amount": put("loan_amount", 223, F.lit(0.0), None),
            "interest_rate": put("interest_rate", 227, F.lit(-1.0)),
            "term_months": put("term_months", 229, F.lit(0)),
            "loan_intent": put("loan_intent", 233, F.lit("YACHT"), None),
            "credit_utilization": put("credit_utilization", 239, F.lit(1.5)),
            "loan_grade": put("loan_grade", 241, F.lit("H")),
            "late_payments": put("late_payments", 251, F.lit(-1)),
            "loan_status": put("loan_status", 257, F.lit(2)),
        }
    )


@query(f"WITH {SPOILED} {VIOLATIONS}")
def row_violations(spark, sf_dir):
    return val.row_violations(spoiled(spark, sf_dir), "application_id", val.EXTENDED)


@query(f"""
WITH {SPOILED}, v AS ({VIOLATIONS})
SELECT field, kind, CAST(count(application_id) AS BIGINT) AS n
FROM (VALUES {", ".join(f"('{f}', '{k}')" for f, k, _ in _EXTENDED_SQL)}) AS r(field, kind)
LEFT JOIN v USING (field, kind) GROUP BY field, kind
""")
def rule_counts(spark, sf_dir):
    return val.rule_counts(spoiled(spark, sf_dir), val.EXTENDED)


@query("""
SELECT o_orderkey AS application_id FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderkey % 20 = 0
""")
def uuid_check(spark, sf_dir):
    """Ids in UUID form, every 20th cut short; the broken ones are reported."""
    a = applications(spark, sf_dir, history=False).select("application_id")
    whole = as_uuid(F.md5(F.col("application_id").cast("string")))
    ids = a.withColumn("id", F.when(F.col("application_id") % 20 == 0, F.substring(whole, 1, 30)).otherwise(whole))
    return val.row_violations(ids, "application_id", [val.uuid_rule("id")]).select("application_id")


@query(f"""
WITH {EXPLAINED}
SELECT application_id, 'default_probability' AS field, 'range' AS kind FROM risk WHERE application_id % 50 < 3
UNION ALL SELECT application_id, 'risk_score', 'range' FROM risk WHERE application_id % 53 = 0
UNION ALL SELECT application_id, 'risk_level', 'category' FROM risk WHERE application_id % 59 = 0
UNION ALL SELECT application_id, 'explanation', 'category' FROM risk WHERE application_id % 61 = 0
""")
def output_bounds(spark, sf_dir):
    """Predictions with spoiled outputs: out of range, NaN, NULL, unknown level or direction."""
    key = F.col("application_id")
    r = with_risk(explained(spark, sf_dir))
    p = F.when(key % 50 == 0, 1.5).when(key % 50 == 1, float("nan")).when(key % 50 == 2, F.lit(None))
    sideways = F.transform(
        "explanation",
        lambda e: F.struct(
            e["feature"].alias("feature"), e["impact"].alias("impact"), F.lit("sideways").alias("direction")
        ),
    )
    out = r.select(
        "application_id",
        p.otherwise(F.col("p")).alias("default_probability"),
        F.when(key % 53 == 0, 101).otherwise(F.col("risk_score")).alias("risk_score"),
        F.when(key % 59 == 0, "EXTREME").otherwise(F.col("risk_level")).alias("risk_level"),
        F.when(key % 61 == 0, sideways).otherwise(F.col("explanation")).alias("explanation"),
    )
    return val.row_violations(out, "application_id", val.OUTPUT)


@query(f"""
WITH {BASE}
SELECT application_id, 'loan_percent_income' AS field FROM base
WHERE income > 0 AND TRY_CAST(loan_amount / income AS DECIMAL(5,4)) IS NULL
UNION ALL SELECT application_id, 'amount' FROM base WHERE application_id % 31 = 0
""")
def decimal_fit(spark, sf_dir):
    """Values too large for their decimal column: the ratio overflows on its own, every 31st amount by hand."""
    a = applications(spark, sf_dir, history=False).select(
        "application_id",
        F.try_divide("loan_amount", F.when(F.col("income") > 0, F.col("income"))).alias("loan_percent_income"),
        F.when(F.col("application_id") % 31 == 0, F.col("loan_amount") + 1e12)
        .otherwise(F.col("loan_amount"))
        .alias("amount"),
    )
    rules = [val.decimal_rule(c, *DECIMAL_LIMITS[c]) for c in ("loan_percent_income", "amount")]
    return val.row_violations(a, "application_id", rules).select("application_id", "field")


#: Columns of both tables with their limits; each value is made longer by the row's key modulo 1.25 times the limit.
_LIMITED = [(t, c, n, n + n // 4) for t, limits in LENGTH_LIMITS.items() for c, n in limits.items()]
_KEY = {"models": "part", "predictions": "application_id"}


@query(f"""
WITH {SCORED}, {METADATA},
models AS (SELECT *, 'models/' || name AS artifact_path FROM metadata),
predictions AS (SELECT application_id, CAST(application_id AS VARCHAR) AS request_id, '1.0.0' AS prediction_version FROM scored)
""" + " UNION ALL ".join(
    f"SELECT {_KEY[t]} AS id, '{t}.{c}' AS field FROM {t} WHERE length({c}) + {_KEY[t]} % {m} > {n}" for t, c, n, m in _LIMITED
))
def length_limits(spark, sf_dir):
    """Every declared limit: text that is too long for its column, per row."""
    models = metadata(spark, sf_dir).withColumnRenamed("dataset_version", "training_dataset")
    key = F.col("application_id")
    tables = {
        "models": models.withColumn("artifact_path", F.concat(F.lit("models/"), "name")),
        "predictions": scored(spark, sf_dir).select(key, key.cast("string").alias("request_id"), F.lit("1.0.0").alias("prediction_version")),
    }
    out = None
    for t, rows in tables.items():
        longer = {c: F.concat(c, F.repeat(F.lit("x"), (F.col(_KEY[t]) % m).cast("int"))) for u, c, _, m in _LIMITED if u == t}
        rules = [val.length_rule(c, n) for u, c, n, _ in _LIMITED if u == t]
        found = val.row_violations(rows.withColumns(longer), _KEY[t], rules)
        found = found.select(F.col(_KEY[t]).alias("id"), F.concat(F.lit(f"{t}."), "field").alias("field"))
        out = found if out is None else out.unionByName(found)
    return out


_CHECKED = ("age", "income", "employment_years", "interest_rate", "loan_amount", "term_months")


@query(f"WITH {BASE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL"
    + (" OR application_id % 17 = 0" if c == "loan_amount" else "")
    + ") AS n_missing FROM base"
    for c in _CHECKED
))
def not_null(spark, sf_dir):
    """NULL and NaN at the model input (every 17th amount is NaN here)."""
    a = applications(spark, sf_dir, history=False)
    nan = F.when(F.col("application_id") % 17 == 0, float("nan")).otherwise(F.col("loan_amount"))
    return val.missing_at_input(a.withColumn("loan_amount", nan), _CHECKED)


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1
""")
def unique_keys(spark, sf_dir):
    return val.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def registry_rows(spark, sf_dir):
    """The registry table: one row per part's metadata; version 0.0.0 of one name is active."""
    rows = model_rows(metadata(spark, sf_dir))
    return reg.activate(rows, "scorecard-7", "0.0.0")


@query("SELECT count(*) FILTER (WHERE p_partkey = 7) AS n_active, count(*) FILTER (WHERE p_partkey = 7) = 1 AS ok FROM part")
def active_invariant(spark, sf_dir):
    return reg.active_count(registry_rows(spark, sf_dir))


@query(f"""
WITH {METADATA}
SELECT name, version, algorithm, roc_auc, pr_auc IS NULL AS pr_auc_absent FROM metadata WHERE part = 7
""")
def active_model(spark, sf_dir):
    row = reg.active_model(registry_rows(spark, sf_dir))
    return row.select("name", "version", "algorithm", "roc_auc", F.col("pr_auc").isNull().alias("pr_auc_absent"))


@query(f"""
WITH {METADATA}
SELECT name, version, algorithm, training_dataset FROM metadata WHERE name = 'scorecard-3' AND version = '2.0.0'
""")
def model_by_version(spark, sf_dir):
    row = reg.model_by_version(registry_rows(spark, sf_dir), "scorecard-3", "2.0.0")
    return row.select("name", "version", "algorithm", "training_dataset")


@query("""
SELECT o_custkey AS batch_id, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY o_custkey HAVING count(*) > 12
""")
def batch_size(spark, sf_dir):
    a = applications(spark, sf_dir, history=False).select(F.col("customer_id").alias("batch_id"))
    return val.oversized_batches(a, "batch_id", 12)


@query(f"""
WITH {BASE}
SELECT 'income' AS "column", 'double' AS expected, 'string' AS actual,
  count(*) FILTER (WHERE application_id % 19 = 0) AS n_bad FROM base
UNION ALL SELECT 'credit_history_years', 'int', 'bigint', 0
UNION ALL SELECT 'late_payments', 'int', NULL, count(*) FROM base
""")
def schema_contract(spark, sf_dir):
    """Text where a number is due, a wider integer, and a missing column."""
    a = applications(spark, sf_dir, history=False)
    text = F.when(F.col("application_id") % 19 == 0, "n/a").otherwise(F.col("income").cast("string"))
    contract = T.StructType(
        [
            T.StructField("age", T.IntegerType()),
            T.StructField("income", T.DoubleType()),
            T.StructField("credit_history_years", T.IntegerType()),
            T.StructField("late_payments", T.IntegerType()),
        ]
    )
    return val.schema_contract(a.withColumn("income", text), contract)


@query(f"""
WITH {APP}, flagged AS (SELECT *, {REQUEST_OK} AS ok FROM app)
SELECT CASE WHEN ok THEN 'valid' ELSE 'quarantined' END AS part, loan_intent, count(*) AS n,
  CAST(sum(CASE WHEN ok THEN 0 ELSE
      CAST(income < 0 AS INTEGER) + CAST(home_ownership = 'PALACE' AS INTEGER)
      + CAST(employment_years IS NULL AS INTEGER) + CAST(interest_rate IS NULL AS INTEGER) END) AS BIGINT)
    AS n_violations
FROM flagged GROUP BY ALL
""")
def quarantine_split(spark, sf_dir):
    good, bad = val.quarantine_split(applications(spark, sf_dir), val.REQUEST)
    none = F.array().cast(bad.schema["violations"].dataType)
    both = good.withColumn("violations", none).select(F.lit("valid").alias("part"), "loan_intent", "violations")
    both = both.unionByName(bad.select(F.lit("quarantined").alias("part"), "loan_intent", "violations"))
    return both.groupBy("part", "loan_intent").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("violations")).cast("bigint").alias("n_violations")
    )


@query("""
SELECT 'customer' AS kind, c_custkey AS id FROM customer WHERE c_custkey = 42
UNION ALL SELECT 'loan', o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0
UNION ALL SELECT 'loan by id', o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey = 77
""")
def lookup_by_id(spark, sf_dir):
    """By one id (the filter reaches the scan) and by a set of ids (semi join)."""
    customers = table(spark, sf_dir, "customer")
    loans = rel.normalise_loans(applications(spark, sf_dir, history=False))
    debtors = customers.where(F.col("c_acctbal") < 0).select("c_custkey")
    one = rel.lookup(customers, "c_custkey", 42).select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"))
    many = rel.lookup_many(loans, "customer_id", debtors).select(F.lit("loan").alias("kind"), "id")
    single = rel.lookup(loans, "id", 77).select(F.lit("loan by id").alias("kind"), "id")
    return one.unionByName(many).unionByName(single)


@query(f"""
WITH {SCORED}
SELECT sha256('prediction|' || application_id) AS id, p AS default_probability FROM scored
WHERE sha256('prediction|' || application_id) < '1'
""")
def prediction_by_id(spark, sf_dir):
    """Stored predictions for a set of prediction ids."""
    p = predictions(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    ids = orders.select(stable_id(F.lit("prediction"), "o_orderkey").alias("id")).where(F.col("id") < "1")
    return rel.lookup_many(p, "id", ids).select("id", "default_probability")
