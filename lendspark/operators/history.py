"""Point-in-time history: what was known about a key before each moment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def with_history(
    df: DataFrame, key: str, ts: str, sums: dict[str, str], gap: str = "INTERVAL '1' DAY"
) -> DataFrame:
    """Add sums (name -> SQL) over rows of the same key that are at least ``gap`` older.

    The row's own values never enter its own history; without a past, or without a
    moment of its own, the sum is 0. Rows without a key share one history. At every
    size the sums are taken per (key, day) and joined back (``history_by_day``), so
    that no task holds a whole key.
    """
    types = df.select(*[F.expr(f"coalesce(sum({e}), 0)").alias(n) for n, e in sums.items()]).schema
    past = history_by_day(df, key, ts, sums, gap).withColumnsRenamed({key: "_key", ts: "_ts"})
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(ts) == F.col("_ts"))
    return df.join(past, same, "left").select(
        *df.columns, *[F.coalesce(F.col(n), F.lit(0)).cast(types[n].dataType).alias(n) for n in sums]
    )


def history_by_day(
    df: DataFrame, key: str, ts: str, sums: dict[str, str], gap: str = "INTERVAL '1' DAY"
) -> DataFrame:
    """The same sums, one row per distinct ``(key, ts)``, with no task bound to one key.

    Rows first collapse to one per ``(key, ts)`` (map-side), then running sums are
    taken per ``(key, day)``, and only day totals, whose number the calendar
    bounds, are summed along a whole key.
    """
    names = list(sums)
    dated = df.where(F.col(ts).isNotNull())  # a row without a moment is in nobody's past
    moments = dated.groupBy(key, ts).agg(*[F.expr(f"sum({e})").alias(n) for n, e in sums.items()])
    # Every moment is a fact at its own time and a question `gap` earlier.
    fact = ", ".join(f"'{n}', {n}" for n in names)
    question = ", ".join(
        f"'{n}', CAST(NULL AS {moments.schema[n].dataType.simpleString()})" for n in names
    )
    both = moments.selectExpr(
        key,
        f"""inline(array(
              named_struct('_t', {ts}, '_at', CAST(NULL AS TIMESTAMP_NTZ), {fact}),
              named_struct('_t', {ts} - {gap}, '_at', {ts}, {question})))""",
    ).withColumn("_day", F.expr("to_date(_t)"))
    in_day = Window.partitionBy(key, "_day").orderBy("_t")
    answers = (
        both.select(key, "_day", "_at", *[F.sum(n).over(in_day).alias(f"_in_{n}") for n in names])
        .where("_at IS NOT NULL")
        .withColumnRenamed("_at", ts)
    )
    earlier_days = (
        Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    )
    before_day = (
        both.groupBy(key, "_day")
        .agg(*[F.sum(n).alias(n) for n in names])
        .select(key, "_day", *[F.sum(n).over(earlier_days).alias(f"_before_{n}") for n in names])
    )
    before_day = before_day.withColumnsRenamed({key: "_key", "_day": "_of"})
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_day") == F.col("_of"))
    return answers.join(before_day, same).selectExpr(
        key, ts, *[f"coalesce(_in_{n}, 0) + coalesce(_before_{n}, 0) AS {n}" for n in names]
    )
