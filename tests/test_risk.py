import math

import pytest

from lendspark.functions.scalar import risk_level, risk_score
from lendspark.plans.scoring import score_batch, with_risk
from lendspark.sources.views import applications, with_scorecard

CASES = [
    (0.0, 0, "LOW"), (0.30, 30, "LOW"), (0.31, 31, "MEDIUM"), (0.73, 73, "HIGH"), (1.0, 100, "HIGH"),
    (0.005, 0, "LOW"), (0.025, 2, "LOW"), (0.305, 30, "LOW"), (0.315, 32, "MEDIUM"), (0.705, 70, "MEDIUM"),
    (-0.01, None, None), (1.01, None, None), (-5.0, None, None), (2.0, None, None), (None, None, None),
    (math.nan, None, None),
]


def test_score_and_level(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _, _) in enumerate(CASES)], "i int, p double")
    got = {r["i"]: (r["s"], r["l"]) for r in df.withColumn("s", risk_score("p")).withColumn("l", risk_level("s")).collect()}
    for i, (_, s, level) in enumerate(CASES):
        assert got[i] == (s, level), CASES[i]


def test_halves_round_like_python(spark):
    ps = [i / 1000 for i in range(0, 1001)]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    assert [r[0] for r in df.select(risk_score("p")).collect()] == [round(p * 100) for p in ps]


def test_batch_keeps_every_row(spark, sf):
    a = applications(spark, sf)
    good, bad = score_batch(a, with_scorecard, "scorecard", "1.0.0")
    assert good.count() + bad.count() == a.count()
    assert good.select("id").distinct().count() == good.count()
    assert {r[0] for r in good.select("prediction_version").distinct().collect()} == {"1.0.0"}


@pytest.mark.parametrize("customer", [None, "customer_id"])
def test_anonymous_predictions(spark, sf, customer):
    good, _ = score_batch(applications(spark, sf), with_scorecard, "s", "1", customer=customer)
    assert (good.where("customer_id IS NULL").count() == good.count()) == (customer is None)
    assert with_risk(good.withColumnRenamed("default_probability", "p")).where("risk_score IS NULL").count() == 0
