"""Models from the documented file to stored, explained predictions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lendspark.errors import InvalidFeatureSchemaError
from lendspark.operators import explain, registry as reg, relational as rel
from lendspark.operators.validate import TRAINING, valid_rows
from lendspark.plans import training as tr
from lendspark.plans.catalogue.base import BASE, REQUEST_OK, SCORED, applications, query
from lendspark.plans.catalogue.tables import raw_file
from lendspark.plans.scoring import check_schema, model_score, resolve_model, score_job
from lendspark.schemas import PREDICTIONS, RAW_FILE
from lendspark.session import scratch_path, stored
from lendspark.sources import readers, sinks

NAME, VERSION = "loan-default-logistic", "1.0.0"


def _saved(spark, rows, dataset):
    """Path of a fitted logistic model with its metadata."""
    model = tr.train(rows, tr.logistic())
    about = reg.ArtifactMetadata(
        NAME, VERSION, "LogisticRegression", dataset, "v1", {}, datetime.now(timezone.utc).replace(microsecond=0),
        tr.input_types(model, rows),
    )
    path = scratch_path(spark, "model")
    reg.save_artifact(spark, model, about, path)
    return path


_RATIOS = """
  CASE WHEN income > 0 THEN loan_amount / income END AS loan_to_income,
  CASE WHEN employment_years IS NOT NULL THEN income / greatest(employment_years, 1) END AS income_per_employment_year,
  credit_history_years / greatest(age, 1)::DOUBLE AS credit_age_ratio"""


def _number_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS feature, CASE WHEN count(*) > count({c}) THEN 'filled and flagged' ELSE 'number' END AS decision,
  count(*) - count({c}) AS n_missing, median({c}::DOUBLE) AS median, NULL::BIGINT AS n_values, count(*) AS n_scored FROM rows"""


def _category_sql(c: str) -> str:
    return f"SELECT '{c}', 'category', count(*) - count({c}), NULL::DOUBLE, count(DISTINCT {c}), count(*) FROM rows"


_FILE_NUMBERS = ("age", "income", "employment_years", "loan_amount", "interest_rate", "credit_history_years", "previous_defaults")
_ABSENT = ("term_months", "late_payments", "credit_utilization", "active_credit_lines", "debt_to_income", "late_payment_rate")


@query(
    f"WITH {BASE}, file AS (SELECT * EXCLUDE (previous_defaults, term_months, credit_utilization),"
    " CASE WHEN application_id % 50 <> 49 THEN previous_defaults END AS previous_defaults FROM base),"
    f" rows AS (SELECT *, {_RATIOS} FROM file WHERE age > 0 AND age < 120 AND income >= 0"
    " AND coalesce(employment_years >= 0, true) AND home_ownership IN ('RENT', 'OWN', 'MORTGAGE', 'OTHER') AND loan_amount > 0"
    " AND coalesce(interest_rate >= 0, true) AND loan_intent IN ('PERSONAL', 'EDUCATION', 'MEDICAL', 'VENTURE', 'HOMEIMPROVEMENT', 'DEBTCONSOLIDATION')"
    " AND credit_history_years >= 0)"
    + " UNION ALL ".join(_number_sql(c) for c in (*_FILE_NUMBERS, "loan_to_income", "income_per_employment_year", "credit_age_ratio"))
    + "".join(f" UNION ALL {_category_sql(c)}" for c in ("home_ownership", "loan_intent", "loan_grade"))
    + "".join(f" UNION ALL SELECT '{c}', 'absent', NULL, NULL, NULL, (SELECT count(*) FROM rows)" for c in _ABSENT)
)
def train_documented_file(spark, sf_dir):
    """The documented 12-column CSV read, trained on, saved, loaded and scored: what was decided per column."""
    path = scratch_path(spark, "csv")
    raw_file(spark, sf_dir).drop("application_id").write.option("header", True).csv(path)
    read = readers.read_raw_csv(spark, path, RAW_FILE).drop(readers.CORRUPT)
    rows = stored(valid_rows(rel.source_to_api(read), TRAINING), "training")
    back = reg.load_artifact(spark, _saved(spark, rows, sf_dir.rsplit("/", 1)[-1]))
    scored = model_score(back.model)(rows).agg(F.count(F.when(F.col("p").between(0, 1), 1)).alias("n_scored"))
    shape = "feature string, decision string, n_missing long, median double, n_values long"
    return spark.createDataFrame(tr.prepared(back.model).decisions(), shape).crossJoin(F.broadcast(scored))


@query(f"WITH {SCORED} SELECT count(*) AS n, 0::BIGINT AS n_off, 0::BIGINT AS n_out_of_order, 19 AS least, 19 AS most FROM scored")
def fitted_explanations(spark, sf_dir):
    """Contributions of a fitted model to every valid application: they add up to its log-odds."""
    rows = stored(valid_rows(applications(spark, sf_dir), TRAINING), "training")
    model = tr.train(rows, tr.logistic())
    intercept, _ = explain.fitted_impacts(model)
    out = explain.explain_fitted(model, model.transform(rows).select(*rows.columns, "rawPrediction"))
    total = F.aggregate("explanation", F.lit(0.0), lambda s, e: s + e["impact"])
    odds = F.get(vector_to_array("rawPrediction"), F.lit(1))
    size = F.transform("explanation", lambda e: F.abs(e["impact"]))
    return out.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(~(F.abs(total + F.lit(intercept) - odds) <= 1e-9), 1)).alias("n_off"),
        F.count(F.when(size != F.reverse(F.array_sort(size)), 1)).alias("n_out_of_order"),
        F.min(F.size("explanation")).alias("least"),
        F.max(F.size("explanation")).alias("most"),
    )


@query(f"""
WITH {SCORED}
SELECT 'run ' || (application_id % 2) AS what, count(*) AS n, count(*) AS n_ids, true AS timed, true AS explained
FROM app WHERE {REQUEST_OK} GROUP BY ALL
UNION ALL SELECT 'quarantined', count(*) FILTER (WHERE NOT coalesce({REQUEST_OK}, false)), NULL, NULL, NULL FROM app
UNION ALL SELECT 'active models', 1, 1, NULL, NULL
""")
def prediction_job(spark, sf_dir):
    """Two batches loaded, checked, scored, explained and stored; the first one twice. Every request is read back once."""
    rows = stored(applications(spark, sf_dir), "applications")
    saved = _saved(spark, valid_rows(rows, TRAINING), sf_dir.rsplit("/", 1)[-1])
    out = scratch_path(spark, "predictions")
    artifact, bad = None, []
    for run in (0, 1, 0):
        artifact, rejected = score_job(rows.where(F.col("application_id") % 2 == run), saved, out, f"batch-{run}", "2024-06-01")
        bad.append(rejected)
    none = reg.model_rows(reg.metadata_frame(spark, artifact.metadata)).limit(0)
    once = resolve_model(none, artifact, saved)
    active = resolve_model(once, artifact, saved).where("is_active")
    runs = sinks.read_runs(spark, out, PREDICTIONS).groupBy(F.concat(F.lit("run "), F.col("request_id").cast("long") % 2).alias("what")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"),
        F.min(F.col("latency_ms") > 0).alias("timed"), F.min(F.size("explanation") > 0).alias("explained"),
    )
    null = F.lit(None).cast("boolean")
    rejected = bad[0].unionByName(bad[1]).agg(F.lit("quarantined").alias("what"), F.count(F.lit(1)).alias("n"))
    rejected = rejected.select("what", "n", F.lit(None).cast("long").alias("n_ids"), null.alias("timed"), null.alias("explained"))
    models = active.agg(F.lit("active models").alias("what"), F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"))
    return runs.unionByName(rejected).unionByName(models.select("what", "n", "n_ids", null.alias("timed"), null.alias("explained")))


@query(f"""
WITH {SCORED}, n AS (SELECT count(*) AS n FROM scored)
SELECT 'as trained' AS tried, 'scored' AS outcome, n FROM n
UNION ALL SELECT 'narrower number', 'scored', n FROM n
UNION ALL SELECT 'column left out', 'missing column income', 0 FROM n
UNION ALL SELECT 'number as text', 'column age is string, not int', 0 FROM n
UNION ALL SELECT 'wider number', 'column late_payments is double, not int', 0 FROM n
UNION ALL SELECT 'two at once', 'missing column home_ownership; column age is string, not int', 0 FROM n
""")
def schema_refusals(spark, sf_dir):
    """A saved model beside tables that differ from the one it was trained on: each is scored or refused by name."""
    rows = stored(valid_rows(applications(spark, sf_dir), TRAINING), "training")
    artifact = reg.load_artifact(spark, _saved(spark, rows, sf_dir.rsplit("/", 1)[-1]))
    text = F.col("age").cast("string")
    tables = {
        "as trained": rows,
        "narrower number": rows.withColumn("age", F.col("age").cast("smallint")),
        "column left out": rows.drop("income"),
        "number as text": rows.withColumn("age", text),
        "wider number": rows.withColumn("late_payments", F.col("late_payments").cast("double")),
        "two at once": rows.drop("home_ownership").withColumn("age", text),
    }
    out = []
    for name, df in tables.items():
        try:
            out.append((name, "scored", model_score(artifact.model)(check_schema(artifact, df)).where("p IS NOT NULL").count()))
        except InvalidFeatureSchemaError as err:
            out.append((name, str(err), 0))
    return spark.createDataFrame(out, "tried string, outcome string, n long")
