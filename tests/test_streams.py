from pyspark.sql import functions as F

from lendspark.operators.validate import REQUEST
from lendspark.plans.scoring import score_batch
from lendspark.session import scratch_path, shared_dir
from lendspark.sources.views import applications, with_scorecard
from lendspark.streaming import jobs


def test_stream_equals_batch_and_resumes(spark, sf, tmp_path):
    a = applications(spark, sf).cache()
    arrivals, out, bad, mark = (str(tmp_path / n) for n in ("in", "out", "bad", "mark"))
    for part in (0, 1):  # the second run takes up where the first stopped
        a.where(F.col("application_id") % 2 == part).write.mode("append").parquet(arrivals)
        stream = jobs.read_stream(spark, arrivals, a.schema, files_per_batch=2)
        jobs.start_scoring(stream, with_scorecard, "s", "1", out, bad, mark).awaitTermination()
    good, rejected = score_batch(a, with_scorecard, "s", "1", REQUEST)
    cols = ["id", "default_probability", "risk_score", "risk_level"]
    stored = spark.read.parquet(out).select(*cols)
    assert stored.exceptAll(good.select(*cols)).count() == 0 == good.select(*cols).exceptAll(stored).count()
    assert spark.read.parquet(bad).count() == rejected.count()


def test_counts_over_several_batches(spark, tmp_path):
    rows = spark.range(0, 3000).selectExpr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS ts",
        "CASE WHEN id % 3 = 0 THEN 'LOW' ELSE 'HIGH' END AS risk_level")
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    rows.repartition(6).write.parquet(source)
    stream = jobs.read_stream(spark, source, rows.schema, files_per_batch=6)
    jobs.start_counts(jobs.windowed_counts(stream, "ts"), out, mark).awaitTermination()
    got = jobs.current_counts(spark, out, ["day_start", "risk_level"])
    want = rows.groupBy(F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day_start"), "risk_level").agg(F.count("*").alias("n"))
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_repeats_are_dropped(spark, tmp_path):
    rows = spark.range(0, 100).selectExpr(
        "timestamp_ntz'2024-01-01 00:00:00' AS ts", "CAST(id % 40 AS STRING) AS request_id")
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    rows.write.parquet(source)
    once = jobs.drop_repeats(jobs.read_stream(spark, source, rows.schema), "ts")
    jobs.start_append(once.select("request_id"), out, mark).awaitTermination()
    assert spark.read.parquet(out).count() == 40


def test_scratch_paths_are_fresh_and_shared(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark))
