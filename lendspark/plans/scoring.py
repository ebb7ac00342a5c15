"""Batch scoring: check, transform, risk columns, prediction rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.errors import InvalidFeatureSchemaError
from lendspark.functions.scalar import risk_level, risk_score, stable_id
from lendspark.operators import explain
from lendspark.operators.registry import Artifact, get_or_register, load_artifact, metadata_frame, model_rows
from lendspark.operators.validate import REQUEST, Rule, quarantine_split, require_columns
from lendspark.plans.prepare import schema_problems
from lendspark.schemas import EXPLANATION
from lendspark.sources.sinks import write_run

Score = Callable[[DataFrame], DataFrame]


def model_score(model: Transformer, schema: T.StructType | None = None) -> Score:
    """A fitted model as a function that adds ``p``; other added columns are dropped."""

    def run(df: DataFrame) -> DataFrame:
        if schema is not None:
            require_columns(df, schema)
        out = model.transform(df)
        if "calibrated" in out.columns:
            p = F.col("calibrated")
        else:
            p = F.get(vector_to_array("probability"), F.lit(1))
        return out.select(*df.columns, p.alias("p"))

    return run


def with_risk(df: DataFrame, p: str = "p") -> DataFrame:
    """Add ``risk_score`` and ``risk_level`` from the probability column."""
    return df.withColumn("risk_score", risk_score(p)).withColumn("risk_level", risk_level("risk_score"))


def prediction_rows(
    df: DataFrame,
    name: str,
    version: str,
    request: str = "application_id",
    customer: str | None = "customer_id",
    explanation: Column | None = None,
    latency_ms: float = 0.0,
) -> DataFrame:
    """Rows of the predictions table; the model version is on every one of them."""
    empty = F.array().cast(EXPLANATION)
    model_id = stable_id(F.lit(name), F.lit(version))
    request_id = F.col(request).cast("string")
    return with_risk(df).select(
        stable_id(model_id, request_id).alias("id"),
        (F.col(customer) if customer else F.lit(None)).cast("string").alias("customer_id"),
        model_id.alias("model_id"),
        request_id.alias("request_id"),
        F.col("p").alias("default_probability"),
        "risk_score",
        "risk_level",
        F.lit(version).alias("prediction_version"),
        F.lit(latency_ms).cast("decimal(10,3)").alias("latency_ms"),
        (empty if explanation is None else explanation).alias("explanation"),
    )


def score_batch(
    df: DataFrame,
    score: Score,
    name: str,
    version: str,
    rules: tuple[Rule, ...] = REQUEST,
    request: str = "application_id",
    customer: str | None = "customer_id",
) -> tuple[DataFrame, DataFrame]:
    """``(predictions, quarantined)``: one bad row does not fail the batch."""
    good, bad = quarantine_split(df, rules)
    return prediction_rows(score(good), name, version, request, customer), bad


def check_schema(artifact: Artifact, df: DataFrame) -> DataFrame:
    """Raise unless the table has the columns and types that the saved model was trained on."""
    problems = schema_problems(artifact.metadata.columns, df.schema)
    if problems:
        raise InvalidFeatureSchemaError("; ".join(problems))
    return df


def resolve_model(models: DataFrame, artifact: Artifact, path: str) -> DataFrame:
    """The registry with the artifact's own row in it; a row that had to be added is active, others as they were."""
    mine = model_rows(metadata_frame(models.sparkSession, artifact.metadata), path).withColumn("is_active", F.lit(True))
    return get_or_register(models, mine.select(*models.columns))


def score_job(
    df: DataFrame,
    artifact_path: str,
    out: str,
    run_id: str,
    day: str,
    rules: tuple[Rule, ...] = REQUEST,
    request: str = "application_id",
    customer: str | None = "customer_id",
) -> tuple[Artifact, DataFrame]:
    """Load, check, score, explain and store one batch; ``(artifact, quarantined)``.

    A linear model stores the contributions of every row, another model none. Repeating a run replaces its rows.
    """
    artifact = load_artifact(df.sparkSession, artifact_path)
    good, bad = quarantine_split(check_schema(artifact, df), rules)
    rows, explanation = model_score(artifact.model)(good), None
    if any(isinstance(s, LogisticRegressionModel) for s in artifact.model.stages):
        rows, explanation = explain.explain_fitted(artifact.model, rows), F.col("explanation")
    about = artifact.metadata
    write_run(prediction_rows(rows, about.name, about.version, request, customer, explanation), out, run_id, day)
    return artifact, bad


def nested_response(df: DataFrame, name: str, version: str) -> DataFrame:
    """The response shape: probability, score, level, model, explanation."""
    return df.select(
        "application_id",
        F.struct(
            F.col("p").alias("default_probability"),
            F.col("risk_score"),
            F.col("risk_level"),
            F.struct(F.lit(name).alias("name"), F.lit(version).alias("version")).alias("model"),
            F.col("explanation"),
        ).alias("response"),
    )
