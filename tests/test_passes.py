"""What several jobs read is written once: later jobs neither build it nor hash its keys again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lendspark.operators import split as spl
from lendspark.plans import prepare
from lendspark.plans.catalogue import QUERIES
from lendspark.session import stored


@pytest.mark.parametrize("add", [spl.stratified_split, spl.stratified_folds, spl.split_and_folds])
def test_a_key_is_hashed_once_a_row(spark, add):
    rows = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("loan_status"))
    out = add(rows, "k")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    assert not [c for c in out.columns if "hash" in c]


@pytest.mark.parametrize(
    "name", ["outliers_iqr", "fold_metrics", "impute_with_flags", "oversample", "split_coverage", "split_overlap_check", "stratified_split"]
)
def test_last_job_reads_what_was_written(spark, sf, name):
    assert not [f for f in QUERIES[name](spark, sf).inputFiles() if f"{sf}/" in f]


def test_stored_rows_are_the_rows(spark):
    rows = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, 2.5, "b")], "k int, x double, s string")
    back = stored(rows, "rows")
    assert back.schema == rows.schema
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_values_of_categories_in_one_pass(spark, monkeypatch):
    monkeypatch.setattr(prepare, "MOST_VALUES", 3)
    rows = spark.createDataFrame([("b", "x"), ("a", None), (None, "y"), ("c", "x"), ("a", "x")], "g string, h string")
    assert prepare._seen(rows, ["g", "h"]) == {"g": ["a", "b", "c"], "h": ["x", "y"]}
    wide = rows.unionByName(spark.createDataFrame([("d", "x")], "g string, h string"))
    with pytest.raises(prepare.DataValidationError, match="not a category: g"):
        prepare._seen(wide, ["g", "h"])
