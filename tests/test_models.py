import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.errors import ExplanationError, InvalidFeatureSchemaError
from lendspark.functions.scalar import logistic
from lendspark.operators import explain
from lendspark.operators.metrics import brier_score
from lendspark.operators.split import split_and_folds
from lendspark.operators.validate import TRAINING, missing_at_input, valid_rows
from lendspark.plans import training as tr
from lendspark.plans.catalogue import QUERIES
from lendspark.plans.scoring import model_score
from lendspark.sources.views import applications


@pytest.fixture(scope="module")
def rows(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rows") / "t")
    valid_rows(applications(spark, sf), TRAINING).write.parquet(path)
    stored = spark.read.parquet(path)
    return split_and_folds(stored, "application_id").cache()


@pytest.fixture(scope="module")
def model(rows):
    return tr.train(rows.where("split = 'train'"), tr.logistic())


def test_probabilities(model, rows):
    out = model_score(model)(rows)
    assert out.where("p BETWEEN 0 AND 1").count() == rows.count()


def test_no_null_reaches_the_model(model, rows):
    seen = model.transform(rows)
    places = seen.select(*[x.alias(f"x{i}") for i, (_, x) in enumerate(tr.prepared(model).slots())])
    assert len(places.columns) == model.stages[-1].numFeatures
    assert sum(r["n_missing"] for r in missing_at_input(places, places.columns).collect()) == 0
    assert rows.where("employment_years IS NULL").count() > 0


def test_only_training_rows_are_learned_from(rows):
    train = rows.where("split = 'train'")
    spoiled = rows.withColumn("income", F.when(F.col("split") == "test", 1e12).otherwise(F.col("income")))
    a = tr.train(train, tr.logistic(maxIter=2))
    b = tr.train(spoiled.where("split = 'train'"), tr.logistic(maxIter=2))
    assert tr.prepared(a).decided == tr.prepared(b).decided
    assert tr.fit_medians(train, ["income"]) == tr.fit_medians(spoiled.where("split = 'train'"), ["income"])


def test_target_is_refused_as_feature():
    with pytest.raises(ValueError, match="loan_status"):
        tr.preprocessing(numeric=["age", "loan_status"])


def test_schema_is_checked(model, rows):
    schema = T.StructType([rows.schema["income"]])
    with pytest.raises(InvalidFeatureSchemaError):
        model_score(model, schema)(rows.drop("income"))


def test_unknown_category_is_scored(model, rows):
    odd = rows.limit(5).withColumn("loan_intent", F.lit("YACHT"))
    assert model_score(model)(odd).where("p IS NOT NULL").count() == 5


def test_boosted_parameters():
    est = tr.boosted("weight", n_estimators=7)
    assert (est.getMaxIter(), est.getMaxDepth(), est.getStepSize()) == (7, 5, 0.05)
    assert (est.getSubsamplingRate(), est.getFeatureSubsetStrategy()) == (0.8, "0.8")
    assert est.getWeightCol() == "weight"


def test_registered_fits_use_the_declared_parameters(spark, sf, model, monkeypatch):
    seen, searched = [], {}
    monkeypatch.setattr(tr, "train", lambda df, est, weighted=False: seen.append((est, weighted)) or model)

    def found(df, **given):
        searched.update(given)
        return df.sparkSession.createDataFrame([(0, {"max_depth": 3.0}, 0.5)], "candidate int, parameters map<string,double>, roc_auc double")

    monkeypatch.setattr(tr, "search", found)
    for name in ("fit_boosted", "fit_forest", "baseline_table"):
        QUERIES[name](spark, sf)
    boosted = [(e, w) for e, w in seen if isinstance(e, GBTClassifier)]
    assert [w for _, w in boosted] == [True, False]
    for e, _ in boosted:
        assert (e.getMaxIter(), e.getMaxDepth(), e.getStepSize(), e.getSubsamplingRate()) == (300, 5, 0.05, 0.8)
    forests = [e for e, _ in seen if isinstance(e, RandomForestClassifier)]
    plain = tr.forest()
    assert [(e.getNumTrees(), e.getMaxDepth()) for e in forests] == [(plain.getNumTrees(), plain.getMaxDepth())] * 2
    assert QUERIES["search"](spark, sf).count() == 1 and searched == {"keep": 0.5}
    assert set(tr.BOOSTED_PARAMS) == set(tr.SEARCH_SPACE) and len(tr.SEARCH_SPACE) == 7


def test_candidates_repeat_with_the_seed():
    a = tr.draw_candidates(tr.SEARCH_SPACE, 20)
    assert a == tr.draw_candidates(tr.SEARCH_SPACE, 20) != tr.draw_candidates(tr.SEARCH_SPACE, 20, seed=1)
    assert len({tuple(c.items()) for c in a}) == 20
    assert len(tr.draw_candidates({"max_depth": (1, 2)}, 20)) == 2


def test_calibration_does_not_hurt_on_its_own_rows(model, rows):
    part = rows.where("split = 'validation'")
    fixed = tr.calibrate(model, part)
    before = brier_score(model_score(model)(part)).first()[0]
    after = brier_score(model_score(fixed)(part)).first()[0]
    assert after <= before + 1e-4


def test_search(rows):
    part = rows.where("split = 'train'").withColumn("fold", F.col("fold") % 2)
    found = tr.search(part, trials=2, space={"max_depth": (1, 2)}, fixed={"n_estimators": 2}, parallelism=2).cache()
    got = found.collect()
    assert sorted(r.parameters["max_depth"] for r in got) == [1.0, 2.0] and {r.parameters["n_estimators"] for r in got} == {2.0}
    assert all(r.folds == 2 and 0 < r.roc_auc < 1 and 0 < r.pr_auc < 1 and r.log_loss > 0 and 0 < r.brier_score < 1 for r in got)
    assert tr.best_candidate(found) == max(got, key=lambda r: (r.roc_auc, -r.candidate)).parameters
    by_hand = []
    for k in (0, 1):
        model = tr.train(part.where(F.col("fold") != k), tr.boosted(n_estimators=2, max_depth=2))
        by_hand.append(tr.evaluate(model, part.where(F.col("fold") == k)).first())
    two = next(r for r in got if r.parameters["max_depth"] == 2.0)
    assert two.roc_auc == pytest.approx(sum(r["roc_auc"] for r in by_hand) / 2, abs=0.03)


def test_search_as_a_race(rows):
    part = rows.where("split = 'train'").withColumn("fold", F.col("fold") % 3)
    found = tr.search(part, trials=4, space={"max_depth": (1, 2, 3, 4)}, fixed={"n_estimators": 1}, keep=0.5).cache()
    assert sorted(r.folds for r in found.collect()) == [1, 1, 3, 3]
    assert tr.best_candidate(found) in [r.parameters for r in found.collect() if r.folds == 3]


def test_comparison(model, rows):
    table = tr.comparison({"a": model, "b": model}, rows.where("split = 'test'")).cache()
    assert table.count() == 2 and tr.best_model(table).first()["model"] in "ab"


def test_linear_contributions_add_up(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 1.0)], "id int, x_a double, x_b double")
    means = explain.feature_means(df, ["x_a", "x_b"])
    impacts = explain.linear_impacts({"a": 0.5, "b": -2.0}, means)
    out = {r["id"]: r["e"] for r in df.select("id", explain.ranked(impacts).alias("e")).collect()}
    assert [(e["feature"], e["impact"], e["direction"]) for e in out[1]] == [("b", -4.0, "negative"), ("a", -0.5, "negative")]
    assert [e["feature"] for e in out[2]] == ["b", "a"]
    z = {1: 0.5 * 2 - 2 * 5, 2: 0.5 * 4 - 2 * 1}
    base = 0.5 * 3 - 2 * 3
    for i in (1, 2):
        assert sum(e["impact"] for e in out[i]) == pytest.approx(z[i] - base)
    with pytest.raises(ExplanationError):
        explain.feature_means(df.where("false"), ["x_a"])


def test_ties_and_zero_impacts(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0)], "x_b double, x_a double, x_c double")
    means = {"x_a": 0.0, "x_b": 2.0, "x_c": 1.0}
    e = df.select(explain.ranked(explain.linear_impacts({"b": 1.0, "a": 1.0, "c": 1.0}, means)).alias("e")).first()["e"]
    assert [(x["feature"], x["direction"]) for x in e] == [("a", "positive"), ("b", "negative"), ("c", "positive")]


def _score(df):
    return df.withColumn("p", F.expr(logistic("0.3 * a - 0.2 * b + 0.5 * a * b")))


def test_sampled_shapley_adds_up(spark):
    df = spark.createDataFrame([(i, float(i % 5), float(i % 3)) for i in range(30)], "id bigint, a double, b double")
    one = df.where("id = 0")
    out = explain.sampled_shapley(df, "id", ["a", "b"], _score, one, permutations=4)
    total = {r["id"]: r["s"] for r in out.groupBy("id").agg(F.sum("impact").alias("s")).collect()}
    p = {r["id"]: r["p"] for r in _score(df).collect()}
    assert len(total) == 30
    for i in p:
        assert total[i] == pytest.approx(p[i] - p[0], abs=1e-12)
    again = explain.sampled_shapley(df.repartition(3), "id", ["a", "b"], _score, one, permutations=4)
    key = ["id", "feature"]
    a = {tuple(r[k] for k in key): r["impact"] for r in out.collect()}
    b = {tuple(r[k] for k in key): r["impact"] for r in again.collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a)
    with pytest.raises(ExplanationError):
        explain.sampled_shapley(df, "id", ["a"], _score, df.where("false"))


def test_shapley_of_a_linear_score_is_exact(spark):
    df = spark.createDataFrame([(1, 3.0, 10.0), (2, 7.0, -4.0)], "id bigint, a double, b double")
    base = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    out = explain.sampled_shapley(df, "id", ["a", "b"], lambda d: d.withColumn("p", F.expr("2 * a + b")), base)
    got = {(r["id"], r["feature"]): r["impact"] for r in out.collect()}
    assert got == pytest.approx({(1, "a"): 4.0, (1, "b"): 8.0, (2, "a"): 12.0, (2, "b"): -6.0})


def test_shapley_draws_from_the_whole_background(spark):
    df = spark.createDataFrame([(i, 0.0) for i in range(3000)], "id bigint, a double")
    base = spark.createDataFrame([(float(i),) for i in range(1, 501)] + [(None,)], "a double")
    plain = lambda d: d.withColumn("p", F.coalesce("a", F.lit(-7.0)))

    def drawn(background):
        out = explain.sampled_shapley(df, "id", ["a"], plain, background, permutations=1)
        return {r["id"]: -r["impact"] for r in out.collect()}

    got = drawn(base)
    assert len(got) == 3000 and set(got.values()) <= {*map(float, range(1, 501)), -7.0}
    assert len(set(got.values())) > 450
    assert got == drawn(base.repartition(7))


def test_registered_shapley_explains_all_test_rows(spark, sf, rows, model, monkeypatch):
    seen, given = [], {}
    whole = explain.sampled_shapley
    monkeypatch.setattr(tr, "train", lambda df, est, weighted=False: seen.append(est) or model)
    monkeypatch.setattr(explain, "sampled_shapley", lambda *a, **k: given.update(k) or whole(*a, **k))
    out = QUERIES["shapley_sampled"](spark, sf).collect()
    assert (seen[0].getMaxIter(), seen[0].getMaxDepth()) == (300, 5) and given == {}
    assert {r["n"] for r in out} == {rows.where("split = 'test'").count()}
    assert len(out) == len(tr.NUMERIC) + len(tr.CATEGORICAL) + 1
