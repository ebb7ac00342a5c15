"""Metrics over tables in which scores or labels are missing; repeated rows."""

import pytest
from pyspark.sql import functions as F

from lendspark.operators import metrics as m
from lendspark.operators import profile as prof

GOOD = [(1, 0.9, 0), (0, 0.2, 0), (1, 0.4, 1), (0, 0.6, 1), (1, 0.7, 1)]
ODD = [(1, None, 0), (0, None, 0), (1, float("nan"), 1), (None, 0.3, 0), (2, 0.3, 1), (0, None, 7)]


@pytest.fixture(scope="module")
def tables(spark):
    shape = "loan_status int, p double, fold int"
    return spark.createDataFrame(GOOD, shape), spark.createDataFrame(GOOD + ODD, shape)


@pytest.mark.parametrize("report", [
    m.roc_auc, m.average_precision, m.precision_recall_f1, m.log_loss, m.brier_score, m.evaluation_report, m.calibration_curve, m.confusion,
    m.threshold_sweep, m.fold_metrics, lambda df: m.evaluation_report(df, by=["fold"]),
])
def test_rows_without_a_score_or_label_change_nothing(tables, report):
    clean, odd = (sorted(map(str, report(t).collect())) for t in tables)
    assert clean == odd


def test_values_of_the_remaining_rows(tables):
    row = m.evaluation_report(tables[1].where("fold = 0")).first()
    assert row["brier_score"] == pytest.approx((0.1**2 + 0.2**2) / 2) and row["roc_auc"] == 1.0


def test_they_are_counted(tables):
    row = m.unscored(tables[1]).first()
    assert (row["n"], row["n_without_score"], row["n_without_label"]) == (11, 4, 2)
    by = {r["fold"]: (r["n"], r["n_without_score"], r["n_without_label"]) for r in m.unscored(tables[1], by=["fold"]).collect()}
    assert by == {0: (5, 2, 1), 1: (5, 1, 1), 7: (1, 1, 0)}


def test_no_scored_row_at_all(tables):
    row = m.evaluation_report(tables[1].where("p IS NULL")).first()
    assert all(v is None for k, v in row.asDict().items())


def test_repeated_rows(spark):
    rows = [(1, "a", None), (1, "a", None), (1, None, "a"), (None, None, None), (None, None, None), (None, None, None), (2, "b", "c")]
    df = spark.createDataFrame(rows, "x int, y string, z string")
    assert tuple(prof.duplicates(df).first()) == (2, 3)
    assert sorted(map(str, map(tuple, prof.without_duplicates(df).collect()))) == sorted(map(str, set(rows)))
    assert tuple(prof.duplicates(df.where("false")).first()) == (0, 0) and prof.without_duplicates(df.where("false")).isEmpty()
    zero = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "x double")
    assert tuple(prof.duplicates(zero).first()) == (2, 2)


def test_one_row_per_key(spark):
    rows = [("k", 2, 5, "x"), ("k", 3, 1, "a"), ("k", 3, 1, "b"), (None, None, 9, "n"), (None, 1, 0, "m")]
    got = prof.one_per_key(spark.createDataFrame(rows, "key string, at int, v int, w string"), ["key"], ["at"]).collect()
    assert sorted(map(tuple, got), key=str) == [("k", 3, 1, "b"), (None, 1, 0, "m")]
