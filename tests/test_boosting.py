"""Boosted trees grown inside tasks are the library's trees."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lendspark.operators.split import stratified_folds
from lendspark.plans import boosting
from lendspark.plans import training as tr
from lendspark.session import stored


@pytest.fixture(scope="module")
def matrix(spark):
    """Two features that count, one of a few values, three of 0 and 1, one constant; two partitions."""
    parts = []
    for part in range(2):
        x = spark.range(part * 3000, part * 3000 + 3000, 1, 1).select(
            F.sin(F.col("id") * 1.7).alias("a"), F.cos(F.col("id") * 0.37 + 1).alias("b"), (F.col("id") % 5).cast("double").alias("c"),
            *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(i + 2)) == 0).cast("double").alias(f"d{i}") for i in range(3)],
            F.lit(1.0).alias("e"), (F.pmod(F.xxhash64("id"), F.lit(100)) / 100.0).alias("noise"),
        )
        y = (F.col("a") + F.col("b") * F.col("c") / 4 + F.col("d0") + F.col("noise") > 1).cast("int")
        weight = F.when(y == 1, 2.0).otherwise(0.75)
        vector = array_to_vector(F.array("a", "b", "c", "d0", "d1", "d2", "e"))
        parts.append(x.select(vector.alias("features"), y.alias("loan_status"), weight.alias("weight")))
    return stored(parts[0].unionByName(parts[1]), "matrix")


def _grown(est, matrix, tasks):
    found = boosting.thresholds(est, matrix)
    spec, start = boosting.specification(est, found), est.copy({est.maxIter: 1}).fit(matrix)
    return boosting.assembled(est, start, spec, boosting.trees(boosting.blocks(est, matrix, found), spec, tasks))


def _margins(model, rows):
    out = model.transform(rows).select(F.col("rawPrediction").cast("string").alias("r")).collect()
    return np.array([float(r.r.strip("[]").split(",")[1]) for r in out])


def _text(tree):
    return re.sub(r"uid=\S+", "", tree.toDebugString)


def test_random_numbers_are_the_librarys(spark):
    for seed, n in ((43, 1000), (-7, 1), (2**40, 3)):
        theirs = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        assert boosting.Draws(n).doubles(seed).tolist() == (first := [theirs.nextDouble() for _ in range(n)])
        assert boosting.Draws(n - n // 3, n // 3).doubles(seed).tolist() == first[n // 3 :]
    theirs, ours = spark._jvm.java.util.Random(7), boosting._JavaRandom(7)
    assert [theirs.nextLong() % 2**64 for _ in range(5)] == [ours.long() for _ in range(5)]


@pytest.mark.parametrize("weight", [None, "weight"])
@pytest.mark.parametrize("tasks", [1, 2, 3])
def test_trees_are_the_librarys(matrix, weight, tasks, monkeypatch):
    monkeypatch.setattr(boosting, "PIECE", 500 * tasks)
    est, conf, size = tr.boosted(weight, n_estimators=8, max_depth=3, min_child_weight=20), matrix.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf.set(size, "700")
    try:
        theirs, ours = est.fit(matrix), _grown(est, matrix, tasks)
    finally:
        conf.unset(size)
    first = theirs.trees[0], ours.trees[0]
    shape = [re.sub(r"Predict: \S+", "", _text(t)) for t in first]
    assert shape[0] == shape[1] and (weight or _text(first[0]) == _text(first[1]))
    assert ours.getMaxIter() == 8 and ours.numClasses == 2 and ours.treeWeights == theirs.treeWeights
    assert _margins(ours, matrix) == pytest.approx(_margins(theirs, matrix), abs=1e-6)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-6)


@pytest.mark.parametrize("given", [{"subsample": 1.0, "colsample_bytree": 1.0}, {"gamma": 0.01}, {"gamma": 10.0}, {"max_depth": 1}])
def test_parameters_mean_what_they_mean_to_the_library(matrix, given):
    est = tr.boosted(n_estimators=4, **{"max_depth": 3, "min_child_weight": 20, **given})
    theirs, ours = est.fit(matrix), _grown(est, matrix, 1)
    assert [t.numNodes for t in ours.trees] == [t.numNodes for t in theirs.trees]
    assert _margins(ours, matrix) == pytest.approx(_margins(theirs, matrix), abs=1e-6)


def test_scores_without_a_model_are_the_models(matrix):
    est = tr.boosted(n_estimators=5, max_depth=3)
    found = boosting.thresholds(est, matrix)
    grown = boosting.trees(boosting.blocks(est, matrix, found), boosting.specification(est, found), 1)
    got = [r.p for r in boosting.scored(matrix, est, found, grown).collect()]
    assert got == pytest.approx((1 / (1 + np.exp(-2 * _margins(_grown(est, matrix, 1), matrix)))).tolist(), abs=1e-9)


def test_large_fits_leave_one_tree_to_the_library(matrix, monkeypatch, tmp_path):
    seen, fit = [], GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, df: seen.append(self.getMaxIter()) or fit(self, df))
    monkeypatch.setattr(boosting, "LIBRARY_ROWS", 6000)
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", 3000)
    model = boosting.fit(tr.boosted(n_estimators=6), matrix)
    assert seen == [1] and model.getNumTrees == 6
    model.save(f"{tmp_path}/model")
    back = GBTClassificationModel.load(f"{tmp_path}/model")
    assert _margins(back, matrix).tolist() == _margins(model, matrix).tolist()
    monkeypatch.setattr(boosting, "LIBRARY_ROWS", 6001)
    boosting.fit(tr.boosted(n_estimators=6), matrix)
    assert seen == [1, 6]


@pytest.fixture(scope="module")
def applicants(spark):
    rows = spark.range(400).select(
        "id", (F.col("id") % 53 + 18).cast("int").alias("age"), (F.pmod(F.xxhash64("id"), F.lit(900)) * 100.0).alias("income"),
        F.when(F.col("id") % 3 == 0, "OWN").otherwise("RENT").alias("home_ownership"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0).cast("int").alias("loan_status"),
    )
    return stored(stratified_folds(rows, "id"), "applicants")


def test_search_starts_no_library_fit(applicants, monkeypatch):
    monkeypatch.setattr(GBTClassifier, "_fit", lambda *a: pytest.fail("one job for each level of each tree"))
    out = tr.search(applicants, trials=3, space={"max_depth": (1, 2, 3)}, fixed={"n_estimators": 3}).collect()
    assert sorted(r.folds for r in out) == [5, 5, 5]
