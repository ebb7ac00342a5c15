"""Trees are fitted on stored feature vectors."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from lendspark.plans import training as tr


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_trees_read_stored_vectors(spark, monkeypatch, kind):
    rows = spark.range(200).select(
        F.col("id").cast("int").alias("age"),
        F.when(F.col("id") % 3 == 0, "OWN").otherwise("RENT").alias("home_ownership"),
        (F.col("id") % 4 == 0).cast("int").alias("loan_status"),
    )
    seen = []
    cls = {"boosted": GBTClassifier, "forest": RandomForestClassifier}[kind]
    fit = cls._fit
    monkeypatch.setattr(cls, "_fit", lambda self, df: seen.append(df) or fit(self, df))
    est = tr.boosted("weight", n_estimators=2) if kind == "boosted" else tr.forest(numTrees=2)
    model = tr.train(rows, est, weighted=kind == "boosted")
    assert seen[0].columns == ["features", "loan_status", *(["weight"] if kind == "boosted" else [])]
    assert seen[0].inputFiles()
    assert model.transform(rows).select("probability").count() == 200
