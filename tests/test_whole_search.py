"""The registered search leaves nothing out."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendspark.operators.split import stratified_folds
from lendspark.plans import training as tr
from lendspark.plans.catalogue import QUERIES, jobs
from lendspark.session import stored


def test_every_candidate_goes_through_every_fold(spark, monkeypatch):
    rows = spark.range(400).select(
        "id", F.lit("train").alias("split"), (F.col("id") % 53 + 18).cast("int").alias("age"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0).cast("int").alias("loan_status"),
    )
    kept = stored(stratified_folds(rows, "id"), "applicants")
    monkeypatch.setattr(jobs, "_training_rows", lambda *a: kept)
    monkeypatch.setattr(tr, "SEARCH_SPACE", {"max_depth": (1, 2, 3), "n_estimators": (1, 2)})
    out = QUERIES["search"](spark, "").collect()
    assert len(out) == 6 and {r.folds for r in out} == {5} and {r.n_rows for r in out} == {400}
