"""Data quality profile: each report reads the table once and returns a few rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendspark.functions.scalar import number
from lendspark.operators.running import order_statistics
from lendspark.schemas import TARGET


def _long(wide: DataFrame, rows: dict[str, dict[str, str]]) -> DataFrame:
    """Turn a one-row aggregate into one row per column name."""
    names = list(next(iter(rows.values())))
    cells = ", ".join(f"'{c}', {', '.join(vals.values())}" for c, vals in rows.items())
    return wide.selectExpr(f"stack({len(rows)}, {cells}) AS (column, {', '.join(names)})")


def _number(c: str) -> str:
    """The column as a double; NaN is no value."""
    return f"nanvl(CAST({c} AS DOUBLE), CAST(NULL AS DOUBLE))"


def _literal(x: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if x is None else number(x)


def _pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form: one row per row and column, values as text; -0.0 is 0.0."""
    types = dict(df.dtypes)
    plain = {c: f"if({c} = 0, CAST(0 AS {types[c]}), {c})" if types[c] in ("float", "double") else c for c in columns}
    cells = ", ".join(f"'{c}', CAST({plain[c]} AS STRING)" for c in columns)
    return df.selectExpr(f"stack({len(columns)}, {cells}) AS (column, value)")


def row_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("int").alias("n_columns")
    )


def null_profile(df: DataFrame) -> DataFrame:
    cols = df.columns
    wide = df.agg(F.expr("count(1) AS _n"), *[F.expr(f"count_if({c} IS NULL) AS {c}") for c in cols])
    share = "round(try_divide({c} * 100D, CAST(_n AS DOUBLE)), 6)"
    return _long(wide, {c: {"n_null": c, "pct_null": share.format(c=c)} for c in cols})


def _repeats(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose 128-bit fingerprint is alone, the others). Only fingerprints are shuffled to find out."""
    marks = {"_h1": F.xxhash64(*df.columns), "_h2": F.xxhash64(F.lit("second"), *df.columns)}
    marked = df.withColumns(marks)
    often = df.select(*[c.alias(n) for n, c in marks.items()]).groupBy(*marks).count().where("count > 1").select(*marks)
    return tuple(marked.join(often, list(marks), how).select(*df.columns) for how in ("left_anti", "left_semi"))


def duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows, and how many such sets there are.

    Whole rows are compared only where fingerprints repeat, so a collision changes nothing.
    """
    sets = _repeats(df)[1].groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return sets.agg(
        F.count(F.when(F.col("_copies") > 1, 1)).alias("n_sets"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("n_duplicates"),
    )


def without_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of rows that are equal in every column; only repeated rows are shuffled whole."""
    alone, repeated = _repeats(df)
    return alone.unionByName(repeated.distinct())


def one_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """For each key the row that comes last by ``newest``; of rows equal in it, the greatest by all other columns."""
    others = [c for c in df.columns if c not in {*keys, *newest}]
    best = df.groupBy(*keys).agg(F.max(F.struct(*newest, *others)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values per column.

    Exact: values collapse per ``(column, value)`` before the shuffle, so a hot
    value costs one row per task. ``approximate`` needs no shuffle of values.
    """
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return _long(wide, {c: {"n_distinct": c} for c in columns})
    return (
        _pairs(df, columns)
        .groupBy("column", "value")
        .agg(F.lit(1).alias("one"))
        .groupBy("column")
        .agg(F.count("value").alias("n_distinct"))
    )


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, min, quartiles, max, mean and sample deviation per numeric column; NaN counts as NULL."""
    quarts = order_statistics(df, {c: (0.25, 0.5, 0.75) for c in columns})
    wide = df.agg(
        *[
            F.expr(f"{fn}({_number(c)}) AS {c}_{name}")
            for c in columns
            for name, fn in _SUMMARY.items()
        ]
    )

    def q(c, p):
        return _literal(quarts[c][p])

    return _long(
        wide,
        {
            c: {
                "n": f"{c}_n",
                "min": f"{c}_min",
                "q25": q(c, 0.25),
                "median": q(c, 0.5),
                "q75": q(c, 0.75),
                "max": f"{c}_max",
                "mean": f"{c}_mean",
                "stddev": f"{c}_sd",
            }
            for c in columns
        },
    )


_SUMMARY = {"n": "count", "min": "min", "max": "max", "mean": "avg", "sd": "stddev_samp"}


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and share of every value of every categorical column."""
    counts = _pairs(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", F.round(F.col("n") / total, 6))


def target_distribution(df: DataFrame, label: str = TARGET) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per class by now, so the total over all of them is a small window.
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


def outliers_iqr(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Values outside ``[q25 - reach * iqr, q75 + reach * iqr]`` per column.

    NaN counts as NULL. A column without values has NULL fences and no outliers.
    """
    quarts = order_statistics(df, {c: (0.25, 0.75) for c in columns})
    fences = {}
    for c in columns:
        q1, q3 = quarts[c][0.25], quarts[c][0.75]
        fences[c] = (None, None) if q1 is None else (q1 - reach * (q3 - q1), q3 + reach * (q3 - q1))
    wide = df.agg(
        *[F.expr(f"count_if({_number(c)} < {_literal(lo)}) AS {c}_low") for c, (lo, _) in fences.items()],
        *[F.expr(f"count_if({_number(c)} > {_literal(hi)}) AS {c}_high") for c, (_, hi) in fences.items()],
    )
    return _long(
        wide,
        {
            c: {
                "lower": _literal(lo),
                "upper": _literal(hi),
                "n_low": f"{c}_low",
                "n_high": f"{c}_high",
            }
            for c, (lo, hi) in fences.items()
        },
    )


def leakage_corr(
    df: DataFrame, columns: Sequence[str], label: str = TARGET, alarm: float = 0.9
) -> DataFrame:
    """Correlation of each column with the target; a very high one hints at leakage."""
    wide = df.agg(
        *[F.expr(f"corr(CAST({c} AS DOUBLE), CAST({label} AS DOUBLE)) AS {c}_r") for c in columns]
    )
    flag = "coalesce(abs({c}_r) >= {a}D, false)"
    return _long(
        wide,
        {c: {"corr": f"round({c}_r, 6)", "suspicious": flag.format(c=c, a=float(alarm))} for c in columns},
    )


def invalid_categories(df: DataFrame, allowed: dict[str, Sequence[str]]) -> DataFrame:
    """Values outside a closed set, with their counts."""
    def quoted(values):
        return ", ".join(f"'{v}'" for v in values)

    cells = ", ".join(
        f"CASE WHEN {c} NOT IN ({quoted(ok)}) THEN named_struct('column', '{c}', 'value', {c}) END"
        for c, ok in allowed.items()
    )
    pairs = df.selectExpr(f"inline(array_compact(array({cells})))")
    return pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, label: str = TARGET) -> DataFrame:
    y = F.col(label).cast("double")
    return df.agg(
        F.round(F.avg(y), 6).alias("positive_rate"),
        F.round(F.avg(1.0 - y), 6).alias("negative_rate"),
        F.round(F.try_divide(F.sum(1.0 - y), F.sum(y)), 6).alias("class_ratio"),
    )


def add_class_weight(df: DataFrame, label: str = TARGET, name: str = "weight") -> DataFrame:
    """Weight positives by negatives / positives, negatives by 1."""
    y = F.col(label).cast("double")
    weight = df.agg(F.try_divide(F.sum(1.0 - y), F.sum(y)).alias("w")).scalar()
    return df.withColumn(name, F.when(F.col(label) == 1, weight).otherwise(F.lit(1.0)))
