"""Every query with SQL, beside that SQL; the others run and give a stable schema."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from lendspark.plans.catalogue import ORACLES, QUERIES

SLOW = {
    "fit_logistic", "fit_forest", "fit_boosted", "fit_oversampled", "search", "baseline_table", "calibrated",
    "artifact_round_trip", "batch_score", "shapley_sampled", "repeatability", "report_sinks",
}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, sf, con, name):
    assert difference(con, entry.queries()[name](spark, sf), entry.oracle_sql()[name]) is None


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["risk_level", "n", "share"] and out.count() > 0


def test_unchecked_queries_are_the_known_ones():
    assert set(QUERIES) - set(ORACLES) == SLOW


def test_repeatability(spark, sf):
    row = entry.queries()["repeatability"](spark, sf).first()
    assert (row["n_moved"], row["n_metrics_changed"]) == (0, 0)


def test_artifact_round_trip(spark, sf):
    row = entry.queries()["artifact_round_trip"](spark, sf).first()
    assert row["n"] > 0 and row["n_different"] == 0 and row["same_metadata"]
    assert row["model"] == "loan-default-logistic:v1.0.0"


def test_report_sinks(spark, sf):
    row = entry.queries()["report_sinks"](spark, sf).first()
    auc = entry.queries()["roc_auc"](spark, sf).first()["roc_auc"]
    assert row["roc_auc"] == pytest.approx(auc, abs=1e-6) and row["n_null"] > 0


def test_batch_score_covers_every_application(spark, sf):
    total = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert sum(r["n"] for r in entry.queries()["batch_score"](spark, sf).collect()) == total
