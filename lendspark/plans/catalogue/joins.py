"""Key joins, delete rules, point-in-time history, set checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendspark.operators import registry as reg
from lendspark.operators import relational as rel
from lendspark.operators.monitor import join_bin_counts
from lendspark.operators.registry import model_rows
from lendspark.operators.split import split_lost, split_overlap, stratified_split
from lendspark.plans.catalogue.base import (
    APP,
    BASE,
    METADATA,
    PREDICTIONS,
    SPLIT,
    applications,
    metadata,
    predictions,
    query,
    scored,
    settled,
    settled_sql,
    table,
)
from lendspark.schemas import TARGET
from lendspark.session import stored


@query(f"""
WITH {BASE}
SELECT application_id AS id, customer_id, loan_amount AS amount, loan_intent AS purpose, age AS parent_age,
  income AS parent_income FROM base
""")
def customer_loans(spark, sf_dir):
    a = applications(spark, sf_dir, history=False)
    joined = rel.join_parent(rel.normalise_loans(a), rel.normalise_customers(a), "customer_id")
    return joined.select(
        "id",
        "customer_id",
        F.col("amount").cast("double").alias("amount"),
        "purpose",
        "parent_age",
        F.col("parent_income").cast("double").alias("parent_income"),
    )


@query(f"""
WITH {APP}, newest AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY application_ts DESC, application_id DESC) AS rn
  FROM app)
SELECT c_custkey AS customer_id, customer_id IS NOT NULL AS has_history,
  coalesce(CAST(credit_history_years AS INTEGER), -1) AS credit_history_years,
  coalesce(late_payments, -1) AS late_payments
FROM customer LEFT JOIN newest ON customer_id = c_custkey AND rn = 1
""")
def customer_history_left(spark, sf_dir):
    """Every customer with the credit history, if there is one."""
    known = applications(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    joined = rel.join_parent(
        customers, rel.normalise_credit_histories(known), "customer_id", "customer_id", "left"
    )
    return joined.select(
        "customer_id",
        F.col("parent_id").isNotNull().alias("has_history"),
        F.coalesce("parent_credit_history_years", F.lit(-1)).alias("credit_history_years"),
        F.coalesce("parent_late_payments", F.lit(-1)).alias("late_payments"),
    )


@query(f"""
WITH {PREDICTIONS}
SELECT p.id, default_probability, customer_id IS NULL AS anonymous, coalesce(c_mktsegment, '-') AS segment
FROM predictions p LEFT JOIN customer ON customer_id = c_custkey
""")
def prediction_customer_left(spark, sf_dir):
    """Predictions with their customer; anonymous ones stay."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    p = predictions(spark, sf_dir)
    joined = rel.join_parent(p, customers, "customer_id", "c_custkey", "left")
    return joined.select(
        "id",
        "default_probability",
        F.col("customer_id").isNull().alias("anonymous"),
        F.coalesce("parent_c_mktsegment", F.lit("-")).alias("segment"),
    )


@query(f"""
WITH {PREDICTIONS.strip()}, {METADATA}
SELECT name, version, count(*) AS n, {settled_sql("avg(default_probability)")} AS mean_p
FROM predictions JOIN metadata ON model_key = part GROUP BY name, version
""")
def prediction_model(spark, sf_dir):
    models = metadata(spark, sf_dir).select("part", "name", "version")
    joined = rel.join_parent(predictions(spark, sf_dir), models, "model_key", "part")
    used = joined.groupBy(F.col("parent_name").alias("name"), F.col("parent_version").alias("version"))
    return settled(used.agg(F.count(F.lit(1)).alias("n"), F.avg("default_probability").alias("mean_p")))


@query(f"""
WITH {METADATA}
SELECT name, version, CASE WHEN part % 3 = 0 THEN 'new' ELSE 'stored' END AS origin FROM metadata
""")
def get_or_register(spark, sf_dir):
    """A registry that lacks a third of the models; each missing one is offered twice."""
    rows = model_rows(metadata(spark, sf_dir)).drop("id")
    m = rows.withColumn("origin", F.lit("stored")).join(
        metadata(spark, sf_dir).where(F.col("part") % 3 != 0).select("name", "version"),
        ["name", "version"],
        "left_semi",
    )
    offered = rows.withColumn("origin", F.lit("new"))
    out = reg.get_or_register(m.select(*offered.columns), offered.unionByName(offered))
    return out.select("name", "version", "origin")


@query(f"""
WITH {PREDICTIONS}
SELECT p.id, model_key FROM predictions p WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = model_key)
""")
def orphans(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return rel.orphans(predictions(spark, sf_dir), parts, "model_key", "p_partkey").select("id", "model_key")


@query(f"""
WITH {BASE}
SELECT application_id AS id, customer_id FROM base JOIN customer ON customer_id = c_custkey WHERE c_acctbal >= 0
""")
def delete_cascade(spark, sf_dir):
    """Loans left after all customers in debt were deleted."""
    gone = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    loans = rel.normalise_loans(applications(spark, sf_dir, history=False))
    return rel.delete_cascade(loans, gone, "customer_id", "c_custkey").select("id", "customer_id")


@query(f"""
WITH {PREDICTIONS}
SELECT p.id, coalesce(CASE WHEN c_custkey IS NULL THEN customer_id END, -1) AS customer_id
FROM predictions p LEFT JOIN customer ON customer_id = c_custkey AND c_nationkey < 5
""")
def delete_set_null(spark, sf_dir):
    gone = table(spark, sf_dir, "customer").where(F.col("c_nationkey") < 5)
    kept = rel.delete_set_null(predictions(spark, sf_dir), gone, "customer_id", "c_custkey")
    return kept.select("id", F.coalesce("customer_id", F.lit(-1)).alias("customer_id"))


@query(f"""
WITH {PREDICTIONS}
SELECT p_partkey AS part FROM part WHERE p_size > 25
  AND EXISTS (SELECT 1 FROM predictions WHERE model_key = p_partkey)
""")
def delete_restrict(spark, sf_dir):
    """Models asked to be deleted that predictions still use."""
    asked = table(spark, sf_dir, "part").where(F.col("p_size") > 25).select(F.col("p_partkey").alias("part"))
    return rel.delete_blocked(asked, predictions(spark, sf_dir), "part", "model_key")


@query(f"WITH {APP} SELECT application_id, late_payments, active_credit_lines, total_debt FROM app")
def prior_history(spark, sf_dir):
    a = applications(spark, sf_dir)
    return a.select("application_id", "late_payments", "active_credit_lines", "total_debt")


@query(f"""
WITH {PREDICTIONS}
SELECT id, default_probability, b.loan_status AS outcome
FROM predictions p JOIN (SELECT application_id, loan_status FROM base WHERE NOT is_open) b USING (application_id)
""")
def outcomes_join(spark, sf_dir):
    """Predictions whose loan has closed, with the outcome."""
    closed = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "O").select(
        F.col("o_orderkey").alias("application_id")
    )
    a = applications(spark, sf_dir, history=False).select("application_id", F.col("loan_status").alias("outcome"))
    outcomes = a.join(closed, "application_id", "left_semi")
    return predictions(spark, sf_dir).join(outcomes, "application_id").select(
        "id", "default_probability", "outcome"
    )


@query(f"""
WITH {BASE}
SELECT CAST(floor(loan_amount / 50000) AS BIGINT) AS bin,
  count(*) FILTER (WHERE application_ts < TIMESTAMP '1998-01-01') AS n_reference,
  count(*) FILTER (WHERE application_ts >= TIMESTAMP '1998-01-01') AS n_current
FROM base GROUP BY 1
""")
def bin_full_outer(spark, sf_dir):
    """Two periods' bin counts side by side; a bin may occur in one period only."""
    a = applications(spark, sf_dir, history=False)
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")

    def counts(rows):
        return rows.groupBy(F.floor(F.col("loan_amount") / 50000.0).alias("bin")).agg(F.count(F.lit(1)).alias("n"))

    before = a.where(F.col("application_ts") < cut)
    after = a.where(F.col("application_ts") >= cut)
    return join_bin_counts(counts(before), counts(after))


def _parts(spark, sf_dir):
    """The scored rows with their part: written once to find the cuts, and once with the part."""
    rows = stored(scored(spark, sf_dir).select("application_id", "customer_id", TARGET), "scored")
    split = stored(stratified_split(rows, "application_id"), "split")
    return split, {n: split.where(F.col("split") == n) for n in ("train", "validation", "test")}


@query(f"""
WITH {SPLIT}
SELECT customer_id, string_agg(DISTINCT split, ',' ORDER BY split) AS parts FROM parted
GROUP BY customer_id HAVING count(DISTINCT split) > 1
UNION ALL
SELECT -1, 'applications in two parts: ' || count(*) FROM (
  SELECT application_id FROM parted GROUP BY application_id HAVING count(DISTINCT split) > 1)
""")
def split_overlap_check(spark, sf_dir):
    """Applications never overlap (last row); customers may, and are listed."""
    _, parts = _parts(spark, sf_dir)
    customers = split_overlap(parts, "customer_id").select("customer_id", F.concat_ws(",", "parts").alias("parts"))
    none = split_overlap(parts, "application_id").agg(
        F.lit(-1).cast("bigint").alias("customer_id"),
        F.concat(F.lit("applications in two parts: "), F.count(F.lit(1)).cast("string")).alias("parts"),
    )
    return customers.unionByName(none)


@query(f"""
WITH {SPLIT}
SELECT 'all parts' AS against, count(*) = 0 AS complete, count(*) AS n_lost FROM parted
WHERE split NOT IN ('train', 'validation', 'test')
UNION ALL SELECT 'without test', count(*) = 0, count(*) FROM parted WHERE split = 'test'
""")
def split_coverage(spark, sf_dir):
    """Nothing is lost by the split; leaving one part out loses exactly that part."""
    whole, parts = _parts(spark, sf_dir)

    def lost(name, used):
        gone = split_lost(whole.select("application_id"), [p.select("application_id") for p in used])
        return gone.agg(
            F.lit(name).alias("against"),
            (F.count(F.lit(1)) == 0).alias("complete"),
            F.count(F.lit(1)).alias("n_lost"),
        )

    return lost("all parts", list(parts.values())).unionByName(
        lost("without test", [parts["train"], parts["validation"]])
    )
