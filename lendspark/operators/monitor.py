"""Monitoring of data, predictions and performance over time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.errors import DataValidationError
from lendspark.operators.metrics import evaluation_report
from lendspark.operators.running import grouped_quantiles, order_statistics
from lendspark.operators.validate import Rule, applicable, is_valid, violations
from lendspark.schemas import PSI_FLOOR, RISK_LEVEL, TARGET

PSI_QUANTILES = (0.10, 0.25, 0.50, 0.75, 0.90)


def risk_distribution(df: DataFrame, level: str = "risk_level") -> DataFrame:
    counts = df.groupBy(level).agg(F.count(F.lit(1)).alias("n"))
    # At most one row per level is left, so the unpartitioned total is tiny.
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


def prediction_counts(df: DataFrame, model: str, ts: str) -> DataFrame:
    return df.groupBy(model, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def latency_stats(df: DataFrame, by: Sequence[str], latency: str = "latency_ms") -> DataFrame:
    """Count, mean, maximum and exact 95th percentile of latency per group."""
    plain = df.groupBy(*by).agg(
        F.count(F.col(latency)).alias("n"),
        F.avg(F.col(latency).cast("double")).alias("mean_ms"),
        F.max(F.col(latency).cast("double")).alias("max_ms"),
    )
    tail = grouped_quantiles(df, by, latency, [0.95], ["p95_ms"])
    # Groups without any latency stay, and so does a NULL group.
    other = tail.select(*[F.col(c).alias(f"_q_{c}") for c in by], "p95_ms")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_q_{c}")) for c in by])
    return plain.join(other, same, "left").select(*plain.columns, "p95_ms")


def error_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rejected rows and violations by kind."""
    rules = applicable(rules, df.columns)
    kinds = F.array_distinct(F.transform(violations(rules), lambda v: v["kind"]))
    return (
        df.where(~is_valid(rules))
        .select(violations(rules).alias("v"), kinds.alias("kinds"))
        .select(F.explode("kinds").alias("kind"), "v")
        .groupBy("kind")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.size(F.filter("v", lambda v: v["kind"] == F.col("kind"))))
            .cast("bigint")
            .alias("n_violations"),
        )
    )


def numeric_bin(value: str, edges: Sequence[float]) -> Column:
    """0 for values up to the first edge, and so on; NULL stays NULL."""
    out = F.when(F.col(value) <= edges[0], 0)
    for i, edge in enumerate(edges[1:], start=1):
        out = out.when(F.col(value) <= edge, i)
    return out.when(F.col(value).isNotNull(), len(edges))


def bin_counts(df: DataFrame, bin_of: Column, is_reference: Column) -> DataFrame:
    """Rows per bin of both periods side by side, an absent bin counted as 0."""
    return df.groupBy(bin_of.alias("bin")).agg(
        F.count(F.when(is_reference, 1)).alias("n_reference"),
        F.count(F.when(~is_reference, 1)).alias("n_current"),
    )


def join_bin_counts(reference: DataFrame, current: DataFrame) -> DataFrame:
    """The same from two separate tables of ``bin, n``: a full outer join of a few rows."""
    return (
        reference.withColumnRenamed("n", "n_reference")
        .join(current.withColumnRenamed("n", "n_current"), "bin", "full_outer")
        .select(
            "bin",
            F.coalesce("n_reference", F.lit(0)).alias("n_reference"),
            F.coalesce("n_current", F.lit(0)).alias("n_current"),
        )
    )


def psi(bins: DataFrame) -> DataFrame:
    """Population stability index of a table of bin counts (an empty bin counts as the floor)."""
    totals = bins.agg(F.expr("struct(sum(n_reference) AS e, sum(n_current) AS a)"))
    shares = bins.withColumn("_t", totals.scalar()).selectExpr(
        f"greatest(try_divide(n_reference, _t.e), {PSI_FLOOR}D) AS e",
        f"greatest(try_divide(n_current, _t.a), {PSI_FLOOR}D) AS a",
    )
    return shares.agg(F.expr("round(sum((a - e) * ln(a / e)), 6) AS psi"))


def psi_numeric(df: DataFrame, value: str, is_reference: Column) -> DataFrame:
    """PSI of a numeric column, binned at the reference period's exact quantiles."""
    reference = df.where(is_reference).select(value)
    found = order_statistics(reference, {value: PSI_QUANTILES})[value]
    edges = sorted({found[q] for q in PSI_QUANTILES if found[q] is not None})
    if not edges:
        raise DataValidationError(f"column {value} has no values in the reference period")
    rows = df.where(F.col(value).isNotNull())
    bins = bin_counts(rows, numeric_bin(value, edges), is_reference)
    return psi(bins).select(
        F.lit(value).alias("column"), "psi"
    )


def psi_categorical(df: DataFrame, columns: Sequence[str], is_reference: Column) -> DataFrame:
    """PSI of category shares per column."""
    rows = df.withColumn("_ref", is_reference)
    cells = ", ".join(f"'{c}', CAST({c} AS STRING)" for c in columns)
    counts = (
        rows.selectExpr("_ref", f"stack({len(columns)}, {cells}) AS (column, value)")
        .where("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.expr("count_if(_ref) AS n_reference"), F.expr("count_if(NOT _ref) AS n_current"))
    )
    # Period sizes per column: one row, read as a scalar.
    sizes = ", ".join(
        f"'{c}', named_struct('e', count_if(_ref AND {c} IS NOT NULL), "
        f"'a', count_if(NOT _ref AND {c} IS NOT NULL))"
        for c in columns
    )
    shares = counts.withColumn("_t", F.element_at(rows.agg(F.expr(f"map({sizes})")).scalar(), F.col("column")))
    shares = shares.selectExpr(
        "column",
        f"greatest(try_divide(n_reference, _t.e), {PSI_FLOOR}D) AS e",
        f"greatest(try_divide(n_current, _t.a), {PSI_FLOOR}D) AS a",
    )
    return shares.groupBy("column").agg(F.expr("round(sum((a - e) * ln(a / e)), 6) AS psi"))


def month(ts: str) -> Column:
    return F.date_format(F.col(ts), "yyyy-MM").alias("month")


def prediction_drift(df: DataFrame, ts: str, level: str = "risk_level") -> DataFrame:
    """Share of each risk level per month and its change from the month before.

    Every month between the first and the last has all levels, with 0 rows where none occurred; a month without
    any prediction has no shares, and there is no change to or from it.
    """
    found = df.groupBy(month(ts), F.col(level)).agg(F.count(F.lit(1)).alias("n"))
    span = found.agg(F.to_date(F.min("month"), "yyyy-MM").alias("lo"), F.to_date(F.max("month"), "yyyy-MM").alias("hi"))
    months = span.where("lo IS NOT NULL").selectExpr("explode(sequence(lo, hi, INTERVAL 1 MONTH)) AS m").select(F.date_format("m", "yyyy-MM").alias("month"))
    grid = months.select("month", F.explode(F.array(*map(F.lit, RISK_LEVEL))).alias(level))
    counts = grid.join(found, ["month", level], "left").fillna(0, ["n"])
    share = F.try_divide("n", F.sum("n").over(Window.partitionBy("month")))
    before = F.lag("_share").over(Window.partitionBy(level).orderBy("month"))
    return (
        counts.withColumn("_share", share)
        .withColumn("_before", before)
        .select(
            "month",
            level,
            "n",
            F.round("_share", 6).alias("share"),
            F.round(F.col("_share") - F.col("_before"), 6).alias("change"),
        )
    )


def performance_by_month(df: DataFrame, ts: str, label: str = TARGET, p: str = "p") -> DataFrame:
    """The evaluation report per month."""
    return evaluation_report(df.select(month(ts), label, p), label, p, ["month"])
