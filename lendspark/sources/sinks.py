"""Writers. Each is one Spark write job, which commits as a whole."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.functions.scalar import stable_id
from lendspark.schemas import EXPERIMENT

ZONES = ("raw", "interim", "processed")


def with_audit(df: DataFrame) -> DataFrame:
    """Creation and change time, taken when the write job runs."""
    now = F.current_timestamp()
    return df.withColumns({"created_at": now, "updated_at": now})


def touch(df: DataFrame) -> DataFrame:
    """Refresh the change time of rows about to be rewritten."""
    return df.withColumn("updated_at", F.current_timestamp())


def write_zone(df: DataFrame, base: str, zone: str, name: str) -> str:
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone}")
    path = f"{base}/{zone}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def append_predictions(df: DataFrame, path: str) -> None:
    """Append, partitioned by model version so that one version's history is one folder."""
    with_audit(df).write.mode("append").partitionBy("prediction_version").parquet(path)


RUN_KEYS = ("prediction_day", "prediction_version", "run_id")
RUNS = "run_id STRING, prediction_day STRING, prediction_version STRING, n_rows BIGINT, seconds DOUBLE"


def _manifest(path: str) -> str:
    return path.rstrip("/") + ".runs"


def write_run(df: DataFrame, path: str, run_id: str, day: str) -> None:
    """Store the predictions of one run, which may be repeated: the same run replaces what it wrote before.

    The rows are first written beside the table; that write is timed, and its milliseconds are the ``latency_ms``
    of every row, since each of them waited for the batch (NULL where the column cannot hold it). Then the run's
    partitions (day, version, run) are replaced as a whole, and last its lines of the manifest. ``read_runs`` shows
    only what the manifest names, so a run that broke off is not seen until it is repeated.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.staging/run={run_id}"
    start = time.perf_counter()
    df.write.mode("overwrite").parquet(staged)
    seconds = time.perf_counter() - start
    rows = spark.read.schema(df.schema).parquet(staged)
    latency = F.lit(round(seconds * 1000, 3)).try_cast("decimal(10,3)")
    keyed = with_audit(rows).withColumns({"latency_ms": latency, "prediction_day": F.lit(day), "run_id": F.lit(run_id)})
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RUN_KEYS).parquet(path)
    counts = rows.groupBy("prediction_version").agg(F.count(F.lit(1)).alias("n_rows"))
    lines = counts.select(F.lit(day).alias("prediction_day"), "prediction_version", "n_rows", F.lit(seconds).alias("seconds"))
    lines.coalesce(1).write.mode("overwrite").json(f"{_manifest(path)}/run_id={run_id}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One line per run, day and version that was stored."""
    return spark.read.schema(RUNS).json(_manifest(path))


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stored predictions of complete runs; ``schema`` is that of the rows given to ``write_run``."""
    audit = T.StructType().add("created_at", T.TimestampType()).add("updated_at", T.TimestampType())
    keys = T.StructType([T.StructField(k, T.StringType()) for k in RUN_KEYS])
    fields = [f for f in [*schema.fields, *audit.fields] if f.name not in RUN_KEYS]
    stored = spark.read.schema(T.StructType([*fields, *keys.fields])).parquet(path)
    return stored.join(read_manifest(spark, path).select(*RUN_KEYS), list(RUN_KEYS), "left_semi")


def append_rows(df: DataFrame, path: str) -> None:
    """Append to the customers, loans, credit_histories or models table."""
    with_audit(df).write.mode("append").parquet(path)


def write_report(df: DataFrame, base: str, name: str, version: str) -> str:
    """A versioned report (quality, evaluation) as JSON lines."""
    path = f"{base}/{name}/version={version}"
    df.write.mode("overwrite").json(path)
    return path


def append_experiment(
    spark: SparkSession,
    path: str,
    *,
    model: str,
    hyperparameters: dict[str, object],
    features: list[str],
    dataset_version: str,
    metrics: dict[str, float],
    seed: int,
    artifact: str,
) -> None:
    """One row per training run."""
    row = (
        None, model, {k: str(v) for k, v in hyperparameters.items()}, features, dataset_version,
        {k: float(v) for k, v in metrics.items()}, seed, artifact, None,
    )
    one = spark.createDataFrame([row], EXPERIMENT).withColumn("logged_at", F.current_timestamp())
    one = one.withColumn("experiment_id", stable_id("model", "dataset_version", "seed", "logged_at"))
    one.write.mode("append").json(path)
