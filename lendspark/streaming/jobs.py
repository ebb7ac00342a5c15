"""The batch functions on a stream: scoring, windowed counts, duplicate suppression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lendspark.operators.validate import REQUEST, Rule
from lendspark.plans.scoring import Score, score_batch


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)
    )


def start_scoring(
    stream: DataFrame,
    score: Score,
    name: str,
    version: str,
    out: str,
    quarantine: str,
    checkpoint: str,
    rules: tuple[Rule, ...] = REQUEST,
) -> StreamingQuery:
    """Score what has arrived; good rows to ``out``, bad ones to ``quarantine``.

    Every micro-batch overwrites its own ``batch=`` folder, so a batch that is run
    again after a failure replaces its output instead of doubling it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        predictions, bad = score_batch(batch, score, name, version, rules)
        predictions.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def windowed_counts(stream: DataFrame, ts: str, level: str = "risk_level") -> DataFrame:
    """Predictions per day and risk level; late rows are taken for one day."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        timed.withWatermark(ts, "1 day")
        .groupBy(F.window(ts, "1 day").alias("w"), level)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("day_start"), level, "n")
    )


def start_counts(counts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Keep every changed count, one folder per micro-batch (see ``current_counts``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_counts(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The newest value of every window."""
    rows = spark.read.parquet(out)
    return rows.groupBy(*keys).agg(F.max_by("n", "batch").alias("n"))


def drop_repeats(stream: DataFrame, ts: str, request: str = "request_id", delay: str = "1 day") -> DataFrame:
    """Only the first row of each request id within the delay."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, delay).dropDuplicatesWithinWatermark([request])


def start_append(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .trigger(availableNow=True)
        .start()
    )
