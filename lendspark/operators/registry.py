"""Model registry: metadata rows, get-or-register, activation, saved artifacts."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.errors import ModelLoadError, ModelNotFoundError, RegistryStateError
from lendspark.functions.scalar import metric, stable_id
from lendspark.schemas import ARTIFACT_METADATA

REGISTRY_METRICS = ("roc_auc", "pr_auc", "f1", "brier_score")


@dataclass(frozen=True)
class ArtifactMetadata:
    """What is recorded beside a saved model."""

    name: str
    version: str
    algorithm: str
    dataset_version: str
    feature_version: str
    metrics: dict[str, float]
    trained_at: datetime
    #: Column -> type of what the model reads; empty where it is not known.
    columns: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Artifact:
    model: PipelineModel
    metadata: ArtifactMetadata


# ---------------------------------------------------------------------- rows
def model_rows(metadata: DataFrame, artifact_path: str = "") -> DataFrame:
    """Registry rows from artifact metadata; a metric that is absent stays NULL."""
    return metadata.select(
        stable_id("name", "version").alias("id"),
        "name",
        "version",
        "algorithm",
        F.col("dataset_version").alias("training_dataset"),
        "feature_version",
        *[metric("metrics", m).alias(m) for m in REGISTRY_METRICS],
        F.lit(artifact_path).alias("artifact_path"),
        "trained_at",
        F.lit(False).alias("is_active"),
    )


def get_or_register(models: DataFrame, candidates: DataFrame) -> DataFrame:
    """The registry with every candidate whose (name, version) it lacked added once."""
    keys = ["name", "version"]
    fresh = candidates.join(models.select(*keys), keys, "left_anti").select(*models.columns)
    payload = [c for c in models.columns if c not in keys]
    once = (
        fresh.groupBy(*keys)
        .agg(F.min(F.struct(*payload)).alias("_r"))
        .select(*keys, "_r.*")
        .select(*models.columns)
    )
    return models.unionByName(once)


def activate(models: DataFrame, name: str, version: str) -> DataFrame:
    """The registry with exactly this model active; a model that is not registered is refused."""
    if model_by_version(models, name, version).isEmpty():
        raise ModelNotFoundError(f"no model {name} {version}")
    chosen = (F.col("name") == name) & (F.col("version") == version)
    return models.withColumn("is_active", chosen)


def active_count(models: DataFrame) -> DataFrame:
    """Number of active rows and whether it is exactly one."""
    n = F.count(F.when(F.col("is_active"), 1))
    return models.agg(n.alias("n_active"), (n == 1).alias("ok"))


def active_model(models: DataFrame) -> DataFrame:
    """The active row; raises when more than one is active."""
    rows = models.where("is_active")
    if len(rows.take(2)) > 1:
        raise RegistryStateError("more than one model is active")
    return rows


def model_by_version(models: DataFrame, name: str, version: str) -> DataFrame:
    return models.where((F.col("name") == name) & (F.col("version") == version))


def latest_versions(models: DataFrame) -> DataFrame:
    """Newest version per model name, by partial aggregation."""
    others = [c for c in models.columns if c != "name"]
    newest = F.max_by(F.struct(*others), F.struct("trained_at", "version"))
    return models.groupBy("name").agg(newest.alias("_r")).select("name", "_r.*")


# ----------------------------------------------------------------- artifacts
def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(where)


def _sidecar(path: str) -> str:
    return path.rstrip("/") + ".metadata"


def save_artifact(
    spark: SparkSession, model: PipelineModel, metadata: ArtifactMetadata, path: str
) -> None:
    """Save the fitted stages and, beside them, one row of metadata as JSON."""
    model.write().overwrite().save(path)
    metadata_frame(spark, metadata).coalesce(1).write.mode("overwrite").json(_sidecar(path))


def metadata_frame(spark: SparkSession, m: ArtifactMetadata) -> DataFrame:
    row = (
        m.name, m.version, m.algorithm, m.dataset_version, m.feature_version,
        {k: float(v) for k, v in m.metrics.items()}, m.trained_at, m.columns,
    )
    return spark.createDataFrame([row], ARTIFACT_METADATA)


def load_metadata(spark: SparkSession, path: str) -> ArtifactMetadata:
    """Read the metadata row as text, so that a broken file is an error, not NULLs."""
    lines = [r["value"] for r in spark.read.text(_sidecar(path)).take(2)]
    if len(lines) != 1:
        raise ModelLoadError(f"metadata of {path} is not one JSON row")
    try:
        raw = json.loads(lines[0])
        at = datetime.fromisoformat(raw["trained_at"].replace("Z", "+00:00"))
        return ArtifactMetadata(
            raw["name"],
            raw["version"],
            raw["algorithm"],
            raw["dataset_version"],
            raw["feature_version"],
            dict(raw.get("metrics", {})),
            at.astimezone(timezone.utc),
            dict(raw.get("columns") or {}),
        )
    except (ValueError, KeyError, TypeError, AttributeError) as err:
        raise ModelLoadError(f"metadata of {path} cannot be read") from err


def load_artifact(spark: SparkSession, path: str) -> Artifact:
    """Load model and metadata; both must exist."""
    if not _exists(spark, path) or not _exists(spark, _sidecar(path)):
        raise ModelNotFoundError(f"no saved model with metadata at {path}")
    metadata = load_metadata(spark, path)
    try:
        model = PipelineModel.load(path)
    except (PySparkException, ValueError, OSError, RuntimeError) as err:
        raise ModelLoadError(f"the model at {path} cannot be read") from err
    except Exception as err:
        if type(err).__name__ != "Py4JJavaError":  # the JVM side failed to read it
            raise
        raise ModelLoadError(f"the model at {path} cannot be read") from err
    return Artifact(model, metadata)
