"""Jobs that write, fit or stream: files, models, micro-batches.

Everything they write goes to a fresh folder under the session's shared folder.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.functions.scalar import model_identity
from lendspark.operators import explain, registry as reg, relational as rel
from lendspark.operators.metrics import calibration_curve, evaluation_report
from lendspark.operators.profile import null_profile
from lendspark.operators.split import oversample, split_and_folds
from lendspark.operators.validate import TRAINING, strict_gate, valid_rows
from lendspark.plans import training as tr
from lendspark.plans.catalogue.base import (
    BASE,
    METADATA,
    REQUEST_OK,
    SCORED,
    applications,
    metadata,
    query,
    scored,
    table,
)
from lendspark.plans.catalogue.tables import raw_file
from lendspark.plans.scoring import model_score, prediction_rows, score_batch
from lendspark.schemas import APPLICATION, RAW_FILE, SEED, TARGET
from lendspark.session import scratch_path, stored
from lendspark.sources import readers, sinks
from lendspark.sources.views import with_scorecard
from lendspark.streaming import jobs as stream


# ------------------------------------------------------------------------ files
@query(f"""
WITH {BASE}
SELECT application_id, age AS person_age, income AS person_income, employment_years AS person_emp_length,
  loan_amount AS loan_amnt, loan_grade, loan_status FROM base WHERE application_id % 101 <> 5
""")
def csv_scan(spark, sf_dir):
    """Written and read as CSV with the declared schema; lines that do not parse are set apart."""
    path = scratch_path(spark, "csv")
    rows = raw_file(spark, sf_dir)
    text = rows.withColumn(
        "person_age",
        F.when(F.col("application_id") % 101 == 5, "old").otherwise(F.col("person_age").cast("string")),
    )
    text.write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("application_id", T.LongType()), *RAW_FILE.fields])
    read = readers.read_raw_csv(spark, path, schema)
    return read.where(F.col("_corrupt").isNull()).select(
        "application_id",
        "person_age",
        "person_income",
        "person_emp_length",
        "loan_amnt",
        "loan_grade",
        "loan_status",
    )


@query(f"""
WITH {BASE}
SELECT application_id, age, income, loan_amount, loan_intent,
  CAST(credit_history_years AS INTEGER) AS credit_history_years FROM base
""")
def application_files(spark, sf_dir):
    """The same applications through CSV and through JSON lines; only rows equal in both survive."""
    rows = rel.feature_frame(
        rel.to_shape(
            applications(spark, sf_dir, history=False),
            T.StructType([T.StructField("application_id", T.LongType()), *APPLICATION.fields]),
        ),
        extra=["application_id"],
    )
    csv, json = scratch_path(spark, "csv"), scratch_path(spark, "json")
    rows.write.option("header", True).csv(csv)
    rows.withColumn("undeclared", F.lit("x")).write.json(json)
    schema = rows.schema
    from_csv = readers.read_applications_csv(spark, csv, schema)
    from_json = readers.read_applications_json(spark, json, schema)
    same = from_csv.intersectAll(from_json)
    return same.select("application_id", "age", "income", "loan_amount", "loan_intent", "credit_history_years")


@query(f"""
WITH {BASE}
SELECT loan_intent, count(*) AS n, CAST(sum(CAST(loan_amount AS DECIMAL(14,2))) AS DOUBLE) AS amount FROM base
GROUP BY loan_intent
""")
def zone_round_trip(spark, sf_dir):
    """raw, interim and processed zones, each written from what the one before holds."""
    base = scratch_path(spark, "zones")
    raw = sinks.write_zone(raw_file(spark, sf_dir), base, "raw", "applications")
    interim = sinks.write_zone(
        rel.source_to_api(readers.read_parquet(spark, raw)), base, "interim", "applications"
    )
    processed = sinks.write_zone(
        rel.api_to_table(readers.read_parquet(spark, interim)), base, "processed", "loans"
    )
    return (
        readers.read_parquet(spark, processed)
        .groupBy(F.col("purpose").alias("loan_intent"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("amount").cast("decimal(14,2)")).cast("double").alias("amount"),
        )
    )


@query(f"""
WITH {SCORED.strip()}, {METADATA}
SELECT 'predictions 1.0.0' AS what, count(*) AS n FROM scored WHERE application_id % 2 = 0
UNION ALL SELECT 'predictions 1.1.0', count(*) FROM scored WHERE application_id % 2 = 1
UNION ALL SELECT 'customers', count(DISTINCT o_custkey) FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'loans', count(*) FROM base
UNION ALL SELECT 'models', count(*) FROM metadata
""")
def prediction_sink(spark, sf_dir):
    """Append predictions of two model versions, customers, loans and models; count what is stored."""
    base = scratch_path(spark, "tables")
    rows, a = scored(spark, sf_dir), applications(spark, sf_dir, history=False)
    for rest, version in ((0, "1.0.0"), (1, "1.1.0")):
        part = rows.where(F.col("application_id") % 2 == rest)
        sinks.append_predictions(prediction_rows(part, "scorecard", version), f"{base}/predictions")
    sinks.append_rows(rel.normalise_customers(a), f"{base}/customers")
    sinks.append_rows(rel.normalise_loans(a), f"{base}/loans")
    sinks.append_rows(reg.model_rows(metadata(spark, sf_dir)), f"{base}/models")
    kept = spark.read.parquet(f"{base}/predictions").groupBy("prediction_version").agg(F.count(F.lit(1)).alias("n"))
    out = kept.select(F.concat(F.lit("predictions "), "prediction_version").alias("what"), "n")
    for name in ("customers", "loans", "models"):
        t = spark.read.parquet(f"{base}/{name}").where(F.col("created_at").isNotNull())
        out = out.unionByName(t.agg(F.lit(name).alias("what"), F.count(F.lit(1)).alias("n")))
    return out


@query()
def report_sinks(spark, sf_dir):
    """Quality report, evaluation report and experiment log, written and read back."""
    base = scratch_path(spark, "reports")
    rows = scored(spark, sf_dir)
    quality = sinks.write_report(null_profile(applications(spark, sf_dir, history=False)), base, "quality", "1")
    metrics = evaluation_report(rows)
    evaluation = sinks.write_report(metrics, base, "evaluation", "1")
    found = spark.read.json(evaluation).first().asDict()
    sinks.append_experiment(
        spark,
        f"{base}/experiments",
        model="scorecard",
        hyperparameters={},
        features=list(APPLICATION.fieldNames()),
        dataset_version=sf_dir.rsplit("/", 1)[-1],
        metrics={k: v for k, v in found.items() if v is not None},
        seed=SEED,
        artifact="none",
    )
    log = spark.read.json(f"{base}/experiments")
    nulls = spark.read.json(quality).agg(F.sum("n_null").alias("n_null"))
    return log.select("model", "dataset_version", F.col("metrics.roc_auc").alias("roc_auc"), "seed").withColumn(
        "n_null", nulls.scalar()
    )


# ----------------------------------------------------------------------- models
def _training_rows(spark, sf_dir):
    """Valid training rows with split and fold. The rows are written, since every fit reads them many times:
    once to find the cuts, and once with split and fold, so that no later pass hashes a key."""
    rows = stored(valid_rows(applications(spark, sf_dir), TRAINING), "valid")
    return stored(split_and_folds(rows, "application_id"), "training")


def _part(rows, name):
    return rows.where(F.col("split") == name)


def _report(model, rows, name):
    return tr.evaluate(model, _part(rows, "validation")).select(F.lit(name).alias("model"), "*")


@query()
def fit_logistic(spark, sf_dir):
    rows = _training_rows(spark, sf_dir)
    return _report(tr.train(_part(rows, "train"), tr.logistic()), rows, "logistic")


@query()
def fit_forest(spark, sf_dir):
    rows = _training_rows(spark, sf_dir)
    model = tr.train(_part(rows, "train"), tr.forest())
    return _report(model, rows, "forest")


@query()
def fit_boosted(spark, sf_dir):
    """The primary model with class weights."""
    rows = _training_rows(spark, sf_dir)
    model = tr.train(_part(rows, "train"), tr.boosted("weight"), weighted=True)
    return _report(model, rows, "boosted")


@query()
def fit_oversampled(spark, sf_dir):
    """Logistic regression on training rows with the minority class repeated."""
    rows = _training_rows(spark, sf_dir)
    model = tr.train(oversample(_part(rows, "train")), tr.logistic())
    return _report(model, rows, "oversampled")


@query()
def search(spark, sf_dir):
    """Cross-validated random search over the whole space, every candidate through every fold:
    parameters, folds and mean metrics of each candidate."""
    rows = _part(_training_rows(spark, sf_dir), "train")
    total = rows.agg(F.count(F.lit(1)).alias("n_rows"))
    found = tr.search(rows)
    return found.withColumns({"parameters": F.to_json("parameters"), "n_rows": total.scalar()})


@query()
def baseline_table(spark, sf_dir):
    """Baselines and primary model on the same validation rows."""
    rows = _training_rows(spark, sf_dir)
    train = _part(rows, "train")
    models = {
        "logistic": tr.train(train, tr.logistic()),
        "forest": tr.train(train, tr.forest()),
        "boosted": tr.train(train, tr.boosted()),
    }
    return tr.comparison(models, _part(rows, "validation"))


@query()
def calibrated(spark, sf_dir):
    """Calibration curve on test rows, before and after isotonic calibration on validation rows."""
    rows = _training_rows(spark, sf_dir)
    model = tr.train(_part(rows, "train"), tr.logistic())
    fixed = tr.calibrate(model, _part(rows, "validation"))
    test = _part(rows, "test")

    def curve(m, name):
        return calibration_curve(model_score(m)(test)).select(F.lit(name).alias("model"), "*")

    return curve(model, "plain").unionByName(curve(fixed, "calibrated"))


@query()
def artifact_round_trip(spark, sf_dir):
    """Train, describe, save, load; the loaded model gives the same probabilities."""
    rows = _training_rows(spark, sf_dir)
    model, meta = tr.train_model(
        _part(rows, "train"),
        sf_dir.rsplit("/", 1)[-1],
        tr.logistic(),
        holdout=_part(rows, "validation"),
        name="loan-default-logistic",
    )
    path = scratch_path(spark, "model")
    reg.save_artifact(spark, model, meta, path)
    back = reg.load_artifact(spark, path)
    test = _part(rows, "test")
    before = model_score(model)(test).select("application_id", F.col("p").alias("saved"))
    after = model_score(back.model)(test).select("application_id", F.col("p").alias("loaded"))
    identity = model_identity(F.lit(back.metadata.name), F.lit(back.metadata.version))
    return before.join(after, "application_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.abs(F.col("saved") - F.col("loaded")) > 1e-12, 1)).alias("n_different"),
        F.max(identity).alias("model"),
        F.lit(back.metadata == meta).alias("same_metadata"),
    )


@query()
def batch_score(spark, sf_dir):
    """Score all applications with a fitted model; invalid ones are quarantined, not fatal."""
    rows = _training_rows(spark, sf_dir)
    model = tr.train(_part(rows, "train"), tr.logistic())
    incoming = applications(spark, sf_dir)
    score = model_score(model, T.StructType([incoming.schema[c] for c in tr.NUMERIC]))
    good, bad = score_batch(incoming, score, "loan-default-logistic", "1.0.0")
    levels = good.groupBy(F.col("risk_level").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return levels.unionByName(bad.agg(F.lit("quarantined").alias("outcome"), F.count(F.lit(1)).alias("n")))


@query()
def shapley_sampled(spark, sf_dir):
    """Sampled contributions of all test rows under the primary model, averaged per feature."""
    rows = _training_rows(spark, sf_dir)
    model = tr.train(_part(rows, "train"), tr.boosted())
    features = [*tr.NUMERIC, *tr.CATEGORICAL, "total_debt"]
    impacts = explain.sampled_shapley(
        _part(rows, "test"), "application_id", features, model_score(model), _part(rows, "train")
    )
    return impacts.groupBy("feature").agg(
        F.round(F.avg(F.abs("impact")), 6).alias("importance"), F.count(F.lit(1)).alias("n")
    )


@query()
def repeatability(spark, sf_dir):
    """Split ids and metrics computed twice from the same input and seed."""
    first = _training_rows(spark, sf_dir)
    second = _training_rows(spark, sf_dir)
    moved = first.select("application_id", "split", "fold").exceptAll(
        second.select("application_id", "split", "fold")
    )
    reports = [
        tr.evaluate(tr.train(_part(r, "train"), tr.logistic()), _part(r, "validation"))
        for r in (first, second)
    ]
    changed = reports[0].exceptAll(reports[1])
    return moved.agg(F.count(F.lit(1)).alias("n_moved")).withColumn(
        "n_metrics_changed", changed.agg(F.count(F.lit(1)).alias("n")).scalar()
    )


@query(f"WITH {BASE} SELECT loan_status, count(*) AS n FROM base WHERE income >= 0 AND home_ownership <> 'PALACE' GROUP BY loan_status")
def strict_gate_pass(spark, sf_dir):
    """The gate lets a clean table through (and stops anything else, see the tests)."""
    clean = valid_rows(applications(spark, sf_dir, history=False), TRAINING)
    return strict_gate(clean, TRAINING).groupBy(TARGET).agg(F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------------- streaming
def _stage(spark, rows, name):
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return path


@query(f"""
WITH {SCORED}
SELECT CAST(application_id AS VARCHAR) AS request_id, p AS default_probability, risk_score, risk_level
FROM risk WHERE {REQUEST_OK}
UNION ALL SELECT 'quarantined', NULL, CAST(count(*) FILTER (WHERE NOT coalesce({REQUEST_OK}, false)) AS INTEGER), NULL
FROM app
""")
def stream_score(spark, sf_dir):
    """Applications arrive as files and are scored by a stream; equal to the batch result."""
    rows = applications(spark, sf_dir)
    path = _stage(spark, rows, "arrivals")
    out, bad, mark = (scratch_path(spark, n) for n in ("scored", "quarantine", "checkpoint"))
    arrivals = stream.read_stream(spark, path, rows.schema, files_per_batch=4)
    stream.start_scoring(arrivals, with_scorecard, "scorecard", "1.0.0", out, bad, mark).awaitTermination()
    good = spark.read.parquet(out).select("request_id", "default_probability", "risk_score", "risk_level")
    rejected = spark.read.parquet(bad).agg(
        F.lit("quarantined").alias("request_id"),
        F.lit(None).cast("double").alias("default_probability"),
        F.count(F.lit(1)).cast("int").alias("risk_score"),
        F.lit(None).cast("string").alias("risk_level"),
    )
    return good.unionByName(rejected)


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS "day", event_type AS risk_level, count(*) AS n FROM events GROUP BY ALL
""")
def stream_counts(spark, sf_dir):
    """Daily counts per kind over a stream of events, kept up to date by every micro-batch."""
    events = table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("risk_level"))
    path = _stage(spark, events, "events")
    out, mark = scratch_path(spark, "counts"), scratch_path(spark, "checkpoint")
    counts = stream.windowed_counts(stream.read_stream(spark, path, events.schema), "ts")
    day = counts.select(F.date_format("day_start", "yyyy-MM-dd").alias("day"), "risk_level", "n")
    stream.start_counts(day, out, mark).awaitTermination()
    return stream.current_counts(spark, out, ["day", "risk_level"])


@query("SELECT event_id AS request_id FROM events")
def stream_dedup(spark, sf_dir):
    """Requests sent twice (every third one) are taken once."""
    events = table(spark, sf_dir, "events").select("ts", F.col("event_id").alias("request_id"))
    twice = events.withColumn("copy", F.explode(F.when(F.col("request_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    path = _stage(spark, twice, "requests")
    out, mark = scratch_path(spark, "once"), scratch_path(spark, "checkpoint")
    once = stream.drop_repeats(stream.read_stream(spark, path, twice.schema), "ts")
    stream.start_append(once.select("request_id"), out, mark).awaitTermination()
    return spark.read.parquet(out)
