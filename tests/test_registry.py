from datetime import datetime, timezone

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lendspark.errors import ModelLoadError, ModelNotFoundError, RegistryStateError
from lendspark.functions.features import DerivedFeatures
from lendspark.operators import registry as reg
from lendspark.operators import relational as rel

META = reg.ArtifactMetadata(
    name="loan-default", version="0.0.1-test", algorithm="Test", dataset_version="small@1",
    feature_version="v0", metrics={"roc_auc": 0.5}, trained_at=datetime(2026, 1, 1, tzinfo=timezone.utc),
)


def test_missing_artifact(spark, tmp_path):
    with pytest.raises(ModelNotFoundError):
        reg.load_artifact(spark, str(tmp_path / "nothing"))


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "deep" / "model")
    reg.save_artifact(spark, PipelineModel([DerivedFeatures()]), META, path)
    back = reg.load_artifact(spark, path)
    assert back.metadata == META
    row = back.model.transform(spark.createDataFrame([(10.0, 20.0)], "loan_amount double, income double")).first()
    assert row["loan_to_income"] == 0.5


def test_missing_metadata(spark, tmp_path):
    path = str(tmp_path / "model")
    PipelineModel([DerivedFeatures()]).write().save(path)
    with pytest.raises(ModelNotFoundError):
        reg.load_artifact(spark, path)


def test_unreadable_parts(spark, tmp_path):
    path = str(tmp_path / "model")
    reg.save_artifact(spark, PipelineModel([DerivedFeatures()]), META, path)
    (tmp_path / "other").mkdir()
    spark.createDataFrame([("{not json",)], "value string").coalesce(1).write.text(str(tmp_path / "other.metadata"))
    with pytest.raises(ModelLoadError):
        reg.load_artifact(spark, str(tmp_path / "other"))
    reg.metadata_frame(spark, META).coalesce(1).write.json(str(tmp_path / "empty.metadata"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(ModelLoadError):
        reg.load_artifact(spark, str(tmp_path / "empty"))


@pytest.fixture
def models(spark):
    rows = reg.model_rows(reg.metadata_frame(spark, META), "somewhere")
    second = rows.withColumn("version", F.lit("0.0.2")).withColumn("id", F.lit("b"))
    return rows.unionByName(second)


def test_absent_metric_stays_null(models):
    row = models.first()
    assert row["roc_auc"] == 0.5 and row["pr_auc"] is None and row["brier_score"] is None


def test_activation(models):
    assert tuple(reg.active_count(models).first()) == (0, False)
    one = reg.activate(models, "loan-default", "0.0.2")
    assert tuple(reg.active_count(one).first()) == (1, True)
    assert [r["version"] for r in reg.active_model(one).collect()] == ["0.0.2"]
    with pytest.raises(RegistryStateError):
        reg.active_model(models.withColumn("is_active", F.lit(True)))


def test_get_or_register(models):
    new = models.withColumn("version", F.lit("3"))
    out = reg.get_or_register(models, new.unionByName(models))
    assert sorted(r["version"] for r in out.collect()) == ["0.0.1-test", "0.0.2", "3"]
    assert reg.get_or_register(out, new).count() == 3


def test_delete_restrict(spark, models):
    used = spark.createDataFrame([("b",)], "model_id string")
    with pytest.raises(RegistryStateError):
        rel.delete_restrict(models, used, "id", "model_id")
    free = models.where("id <> 'b'")
    assert rel.delete_restrict(free, used, "id", "model_id") is free


def test_activating_an_unknown_version_is_refused(spark):
    from lendspark.errors import ModelNotFoundError
    from lendspark.operators.registry import activate

    models = spark.createDataFrame([("m", "1", True)], "name string, version string, is_active boolean")
    with pytest.raises(ModelNotFoundError):
        activate(models, "m", "2")
