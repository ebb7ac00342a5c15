"""Running sums, quantiles, history, splits and metrics against brute force."""

from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendspark.operators import history, metrics, running, split


@pytest.fixture(scope="module")
def numbers(spark):
    """Values with a third of all rows tied, NULLs and NaN."""
    rng = np.random.default_rng(1)
    x = [float(v) for v in rng.normal(size=2000)] + [0.25] * 1000 + [None] * 20 + [float("nan")] * 10
    y = [int(v) for v in rng.integers(0, 50, size=len(x))]
    return spark.createDataFrame(list(zip(x, y)), "x double, y int").repartition(4)


@pytest.mark.parametrize("slack", [running.SLACK, 0.2, 0.0])
def test_quantiles(numbers, slack):
    qs = (0.0, 0.01, 0.333, 0.5, 0.9, 1.0)
    got = running.order_statistics(numbers, {"x": qs, "y": qs}, slack=slack)
    pdf = numbers.toPandas()
    for c in "xy":
        for q in qs:
            assert got[c][q] == pytest.approx(pdf[c].dropna().quantile(q), rel=1e-12)


def test_quantile_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert running.order_statistics(empty, {"x": (0.5,)}) == {"x": {0.5: None}}


@pytest.mark.parametrize("edges", [[], [-1.0, 0.0, 0.25, 0.7]])
def test_running_totals(numbers, edges):
    table = numbers.where("x IS NOT NULL AND NOT isnan(x)").groupBy("y", "x").agg(F.count("*").alias("n"))
    rows = running.running_totals(table, "x", ["n"], ["y"], edges).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r["y"]].append(r)
    assert len(rows) == table.count()
    for g in groups.values():
        below = 0
        for r in sorted(g, key=lambda r: r["x"]):
            assert r["n_below"] == below
            below += r["n"]
        assert {r["n_total"] for r in g} == {below}


def test_running_totals_of_odd_values_do_not_depend_on_parts(numbers):
    """NULL and NaN values have the same place, and the result the same schema, whatever the parts."""
    table = numbers.groupBy("x").agg(F.count("*").alias("n"))
    one, many = (running.running_totals(table, "x", ["n"], [], e) for e in ([], [-1.0, 0.0, 0.25, 0.7]))
    assert one.schema == many.schema
    rows = [sorted(map(str, d.collect())) for d in (one, many)]
    assert rows[0] == rows[1] and len(rows[0]) == table.count()


def test_edges_are_even_by_distinct_values(numbers):
    assert running.value_edges(numbers, "x") == []
    edges = running.value_edges(numbers, "x", per_part=250)
    assert 7 <= len(edges) <= 9 and edges == sorted(edges)
    values = sorted({r["x"] for r in numbers.where("NOT isnan(x)").collect() if r["x"] is not None})
    cuts = [0, *np.searchsorted(values, edges), len(values)]
    assert max(np.diff(cuts)) < 2 * len(values) / (len(edges) + 1)


def test_grouped_quantiles(numbers):
    clean = numbers.where("NOT isnan(x)")
    got = {r["y"]: r["q"] for r in running.grouped_quantiles(clean, ["y"], "x", [0.95], ["q"]).collect()}
    for y, g in clean.toPandas().dropna().groupby("y"):
        assert got[y] == pytest.approx(g["x"].quantile(0.95), rel=1e-12)


@pytest.fixture(scope="module")
def visits(spark):
    """A third of all rows belong to one key; times fall anywhere in the day, with repeats."""
    rng = np.random.default_rng(2)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(900):
        key = 0 if i % 3 == 0 else int(rng.integers(1, 40))
        at = start + timedelta(hours=int(rng.integers(0, 24 * 12)))
        rows.append((i, key, at, int(rng.integers(0, 5)), bool(rng.integers(0, 2))))
    return spark.createDataFrame(rows, "id int, key int, at timestamp_ntz, n int, open boolean")


def test_history(visits):
    sums = {"past_n": "n", "past_open": "CASE WHEN open THEN CAST(n AS DECIMAL(14,2)) END"}
    got = {r["id"]: r for r in history.with_history(visits, "key", "at", sums).collect()}
    rows = visits.collect()
    assert len(got) == len(rows)
    for r in rows:
        past = [o for o in rows if o["key"] == r["key"] and o["at"] <= r["at"] - timedelta(days=1)]
        assert got[r["id"]]["past_n"] == sum(o["n"] for o in past)
        assert float(got[r["id"]]["past_open"]) == sum(o["n"] for o in past if o["open"])


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "abc"[min(i % 7, 2)], float(rng.random())) for i in range(3000)] + [(9999, "rare", 0.5)]
    return spark.createDataFrame(rows, "id int, label string, p double").repartition(5)


def test_split_sizes_are_exact_per_class(labelled):
    out = split.stratified_split(labelled, "id", "label")
    assert out.where("split IS NULL").count() == 0
    counts = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    for label, n in {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}.items():
        assert counts.get((label, "train"), 0) == 70 * n // 100
        assert counts.get((label, "validation"), 0) == 85 * n // 100 - 70 * n // 100


def test_split_does_not_depend_on_partitioning(labelled):
    a = split.stratified_split(labelled, "id", "label").select("id", "split")
    b = split.stratified_split(labelled.repartition(1), "id", "label").select("id", "split")
    assert a.exceptAll(b).count() == 0
    c = split.stratified_split(labelled, "id", "label", seed=7).select("id", "split")
    assert a.exceptAll(c).count() > 0


def test_copies_of_a_row_share_their_part(labelled):
    copies = labelled.where("id = 4").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("n")
    many = labelled.unionByName(copies)
    out = split.stratified_split(many.withColumn("label", F.lit(1)), "id", "label")
    assert out.groupBy("id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0


def test_folds(labelled):
    out = split.stratified_folds(labelled.where("label <> 'rare'"), "id", "label")
    sizes = [r["count"] for r in out.groupBy("label", "fold").count().collect()]
    assert len(sizes) == 15
    by_label = out.groupBy("label", "fold").count().groupBy("label").agg((F.max("count") - F.min("count")).alias("d"))
    assert by_label.where("d > 1").count() == 0


def test_split_and_folds_agree_with_the_split(labelled):
    both = split.split_and_folds(labelled, "id", "label")
    plain = split.stratified_split(labelled, "id", "label").select("id", "split")
    assert both.select("id", "split").exceptAll(plain).count() == 0
    assert both.where("(fold IS NULL) <> (split <> 'train')").count() == 0
    sizes = both.where("split = 'train' AND label <> 'rare'").groupBy("label", "fold").count()
    spread = sizes.groupBy("label").agg((F.max("count") - F.min("count")).alias("d"), F.count("*").alias("n"))
    assert [(r["n"], r["d"] <= 1) for r in spread.collect()] == [(5, True)] * 3


def test_time_split_keeps_moments_together(visits):
    out = split.time_split(visits, "at")
    last = {r["split"]: (r["a"], r["b"]) for r in out.groupBy("split").agg(F.min("at").alias("a"), F.max("at").alias("b")).collect()}
    assert last["train"][1] < last["validation"][0] and last["validation"][1] < last["test"][0]


def test_oversample_balances(labelled):
    two = labelled.withColumn("y", (F.col("id") % 5 == 0).cast("int"))
    out = split.oversample(two, "y")
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    plain = {r["y"]: r["count"] for r in two.groupBy("y").count().collect()}
    assert counts[0] == plain[0] and counts[1] == plain[1] * (plain[0] // plain[1])


@pytest.mark.parametrize("digits", [1, 2, 17])
@pytest.mark.parametrize("edges", [[], [0.1, 0.4, 0.5, 0.9]])
def test_auc_and_average_precision(spark, digits, edges):
    rng = np.random.default_rng(4)
    p = [round(float(v), digits) for v in rng.random(400)] + [0.5] * 200
    y = [int(rng.random() < v) for v in p]
    df = spark.createDataFrame(list(zip(y, p)), "loan_status int, p double")
    pos = [s for s, t in zip(p, y) if t]
    neg = [s for s, t in zip(p, y) if not t]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap = 0.0
    for s in sorted(set(p), reverse=True):
        hits = sum(1 for a in pos if a >= s)
        ap += sum(1 for a in pos if a == s) / len(pos) * hits / sum(1 for a in p if a >= s)
    row = metrics.evaluation_report(df, edges=edges).first()
    assert row["roc_auc"] == pytest.approx(auc, abs=1e-6)
    assert row["pr_auc"] == pytest.approx(ap, abs=1e-6)
    assert row["brier_score"] == pytest.approx(np.mean([(a - b) ** 2 for a, b in zip(p, y)]), abs=1e-6)


def test_one_class_gives_null(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.9)], "loan_status int, p double")
    row = metrics.evaluation_report(df).first()
    assert row["roc_auc"] is None and row["recall"] is None and row["brier_score"] is not None


def test_log_loss_is_finite_at_the_ends(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 0.0), (1, 1.0)], "loan_status int, p double")
    assert 0 < metrics.log_loss(df).first()[0] < 100


def test_split_labels_with_odd_characters(spark):
    from lendspark.operators.split import stratified_split

    rows = [(i, label) for i, label in enumerate(["a\\b", "it's", "\\"] * 20)]
    out = stratified_split(spark.createDataFrame(rows, "id long, y string"), "id", "y").groupBy("y", "split").count().collect()
    assert {(r["y"], r["split"]): r["count"] for r in out} == {
        (y, s): n for y in ("a\\b", "it's", "\\") for s, n in (("train", 14), ("validation", 3), ("test", 3))
    }


def test_drift_fills_absent_levels_and_months(spark):
    from lendspark.operators.monitor import prediction_drift

    rows = [("2024-01-05", "HIGH")] + [("2024-01-06", "LOW")] * 9 + [("2024-02-01", "LOW")] + [("2024-04-01", "HIGH"), ("2024-04-02", "LOW")]
    df = spark.createDataFrame(rows, "d string, risk_level string").selectExpr("CAST(d AS TIMESTAMP_NTZ) AS ts", "risk_level")
    got = {(r["month"], r["risk_level"]): (r["n"], r["change"]) for r in prediction_drift(df, "ts").collect()}
    assert len(got) == 12 and got["2024-02", "HIGH"] == (0, -0.1) and got["2024-03", "LOW"] == (0, None)
    assert got["2024-04", "HIGH"] == (1, None)


def test_latency_keeps_groups_without_latency(spark):
    from lendspark.operators.monitor import latency_stats

    df = spark.createDataFrame([("a", 1.0), ("b", None), (None, 3.0)], "g string, latency_ms double")
    assert {r["g"]: (r["n"], r["p95_ms"]) for r in latency_stats(df, ["g"]).collect()} == {"a": (1, 1.0), "b": (0, None), None: (1, 3.0)}
