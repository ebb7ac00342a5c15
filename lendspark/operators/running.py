"""Running sums and exact order statistics without a single-task sort of the data."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendspark.functions.scalar import number

#: Distinct values that one task sorts; as many parts as that takes.
VALUES_PER_PART = 500_000
#: Rank error of the first pass is 1 / ACCURACY of the row count. Results do not depend on it: a finer first pass leaves
#: fewer rows to count exactly, but every task then sends a larger sketch of each column to the one task that merges them.
ACCURACY = 10_000
#: Ranks on either side of a quantile that are looked at exactly, as a share of all.
SLACK = 4 / ACCURACY


def value_edges(
    df: DataFrame, value: str, per_part: int = VALUES_PER_PART, parts: int | None = None
) -> list[float]:
    """Cut points between parts with about ``per_part`` distinct values each; none between less than two parts.

    Parts are even by distinct values, so a value that most rows share does not leave the others to one part.
    """
    if parts is None:
        parts = math.ceil(df.agg(F.approx_count_distinct(value)).first()[0] / per_part)
    if parts < 2:
        return []
    grid = [i / parts for i in range(1, parts)]
    distinct = df.select(F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)").distinct()
    edges = distinct.agg(F.percentile_approx("v", grid, max(ACCURACY, 20 * parts))).first()[0]
    return sorted(set(edges or []))


def running_totals(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    edges: Sequence[float] = (),
) -> DataFrame:
    """Add ``<s>_below`` (sum over smaller values) and ``<s>_total`` for each sum column.

    ``df`` holds one row per ``(by, value)``. The values are cut into parts at ``edges``
    (at zero if there are none): running sums run inside a part, and only part totals
    run across parts. NULL values come first, NaN last.
    """
    by, edges = list(by), list(edges) or [0.0]
    cut = Bucketizer(
        splits=[-math.inf, *edges, math.inf], inputCol="_v", outputCol="_part", handleInvalid="keep"
    )
    parts = cut.transform(df.withColumn("_v", F.col(value).cast("double"))).drop("_v")
    inside = (
        Window.partitionBy(*by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    across = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    totals = parts.groupBy(*by, "_part").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    totals = totals.select(
        *[F.col(b).alias(f"_by_{b}") for b in by],
        F.col("_part").alias("_p"),
        *[F.coalesce(F.sum(f"_{s}").over(across), F.lit(0)).alias(f"_{s}_before") for s in sums],
        *[F.sum(f"_{s}").over(whole).alias(f"{s}_total") for s in sums],
    )
    inner = parts.withColumns(
        {f"_{s}_in": F.coalesce(F.sum(s).over(inside), F.lit(0)) for s in sums}
    )
    same = F.col("_part").eqNullSafe(F.col("_p"))  # NULL values are a part of their own, the first
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return (
        inner.join(totals, same)
        .withColumns({f"{s}_below": F.col(f"_{s}_in") + F.col(f"_{s}_before") for s in sums})
        .select(*df.columns, *[f"{s}_below" for s in sums], *[f"{s}_total" for s in sums])
    )


def order_statistics(
    df: DataFrame, wanted: dict[str, Iterable[float]], kind: str = "continuous", slack: float = SLACK
) -> dict[str, dict[float, float | None]]:
    """Exact quantiles of whole columns as plain numbers (NULL and NaN left out).

    ``kind`` is ``continuous`` (interpolated between the two nearest ranks) or
    ``rank`` (the value at 1-based rank ``floor(q * n)``, at least 1).

    The exact ``percentile`` aggregate keeps every distinct value of a group in
    one buffer. Here an approximate pass brackets each quantile, and only rows
    inside a bracket, collapsed by value, are counted exactly. A bracket that misses
    its rank is widened to the whole column, once.
    """
    columns = list(wanted)
    probs = {c: sorted(set(ps)) for c, ps in wanted.items()}
    clean = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    df = df.select(*[clean[c].alias(c) for c in columns])
    first = []
    for i, c in enumerate(columns):
        around = [min(max(p + s, 0.0), 1.0) for p in probs[c] for s in (-slack, slack)]
        first += [
            F.expr(f"count({c}) AS n{i}"),
            F.expr(f"min({c}) AS min{i}"),
            F.expr(f"max({c}) AS max{i}"),
            F.percentile_approx(c, around, ACCURACY).alias(f"q{i}"),
        ]
    stats = df.agg(*first).first().asDict()

    ranks: dict[tuple[str, float], tuple[int, int, float]] = {}
    brackets: dict[tuple[str, float], tuple[float, float]] = {}
    result: dict[str, dict[float, float | None]] = {c: {} for c in columns}
    for i, c in enumerate(columns):
        n = stats[f"n{i}"]
        for j, p in enumerate(probs[c]):
            if n == 0:
                result[c][p] = None
                continue
            if kind == "continuous":
                at = (n - 1) * p
                ranks[c, p] = (math.floor(at), math.ceil(at), at - math.floor(at))
            else:
                k = max(_floor_share(n, p), 1) - 1
                ranks[c, p] = (k, k, 0.0)
            brackets[c, p] = (stats[f"q{i}"][2 * j], stats[f"q{i}"][2 * j + 1])
    open_ends = {c: (stats[f"min{i}"], stats[f"max{i}"]) for i, c in enumerate(columns)}
    todo = dict(brackets)
    while todo:
        values = _pick(df, todo, ranks, open_ends)
        missing = {}
        for (c, p), got in values.items():
            if got is None:  # the bracket missed the rank: take the whole range
                if todo[c, p] == open_ends[c]:
                    raise RuntimeError(f"column {c} changed between two reads")
                missing[c, p] = open_ends[c]
            else:
                lo, hi = got
                result[c][p] = lo + (hi - lo) * ranks[c, p][2]
        todo = missing
    return result


def _floor_share(n: int, p: float) -> int:
    """``floor(n * p)`` in whole numbers: shares are hundredths or finer decimals."""
    return n * round(p * 1_000_000) // 1_000_000


def _pick(df, brackets, ranks, open_ends):
    """Values at the two ranks of every bracket; None where a rank lies outside."""
    distinct = sorted({(c, lo, hi) for (c, _), (lo, hi) in brackets.items()})
    index = {b: w for w, b in enumerate(distinct)}
    entries = ", ".join(
        f"CASE WHEN {c} BETWEEN {number(lo)} AND {number(hi)} THEN named_struct('w', {w}, 'v', {c}) END"
        if (lo, hi) != open_ends[c]
        else f"CASE WHEN {c} IS NOT NULL THEN named_struct('w', {w}, 'v', {c}) END"
        for (c, lo, hi), w in index.items()
    )
    inside = F.expr(f"array_compact(array({entries}))")
    below = {w: 0 for w in index.values()}
    counted = [(c, lo, w) for (c, lo, _), w in index.items() if lo > open_ends[c][0]]
    if counted:
        row = df.agg(
            *[F.count(F.when(F.col(c) < lo, 1)).alias(f"b{w}") for c, lo, w in counted]
        ).first()
        below.update({w: row[f"b{w}"] for _, _, w in counted})
    upto = Window.partitionBy("w").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = (
        df.select(F.explode(inside).alias("x"))
        .groupBy("x.w", "x.v")
        .count()
        .withColumn("through", F.sum("count").over(upto))
        .withColumn("before", F.col("through") - F.col("count"))
    )
    asked = []
    for (c, p), (lo, hi) in brackets.items():
        w = index[c, lo, hi]
        asked += [(w, k - below[w]) for k in ranks[c, p][:2]]
    hit = F.lit(False)
    for w, k in set(asked):
        hit = hit | ((F.col("w") == w) & (F.col("before") <= k) & (F.col("through") > k))
    rows = running.where(hit).collect()  # at most two values per quantile

    def at(w, k):
        return next((r["v"] for r in rows if r["w"] == w and r["before"] <= k < r["through"]), None)

    out = {}
    for (c, p), (lo, hi) in brackets.items():
        w = index[c, lo, hi]
        pair = tuple(at(w, k - below[w]) for k in ranks[c, p][:2])
        out[c, p] = None if None in pair else pair
    return out


def grouped_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Interpolated quantiles per group, one output column per probability.

    Values collapse to one row per ``(group, value)`` before any ordering, so a
    hot group is split by value, not held in one buffer.
    """
    df = df.where(F.col(value).isNotNull())
    edges = value_edges(df, value)
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, value, ["n"], by, edges)
    picks = []
    for i, p in enumerate(probs):
        at = (F.col("n_total") - 1) * F.lit(float(p))
        for side, k in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picked = (F.col("n_below") <= k) & (k < F.col("n_below") + F.col("n"))
            picks.append(F.max(F.when(picked, F.col(value).cast("double"))).alias(f"_{side}{i}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_frac{i}"))
    return (
        ranked.groupBy(*by)
        .agg(*picks)
        .select(
            *by,
            *[
                (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_frac{i}")).alias(n)
                for i, n in enumerate(names)
            ],
        )
    )
