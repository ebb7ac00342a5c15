"""Feature contributions: exact for linear models, sampled Shapley values for any model."""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.errors import ExplanationError
from lendspark.functions.features import add_derived_features
from lendspark.functions.scalar import direction
from lendspark.plans.prepare import PreparedColumns
from lendspark.schemas import SEED


def feature_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Centres for ``linear_contributions``: one row of averages."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    missing = [c for c in columns if row[c] is None]
    if missing:
        raise ExplanationError(f"no values to centre on in: {', '.join(missing)}")
    return row.asDict()


def linear_impacts(
    weights: dict[str, float], means: dict[str, float], prefix: str = "x_", digits: int = 6
) -> dict[str, Column]:
    """Additive log-odds terms ``weight * (x - mean)`` per feature."""
    return {
        f: F.round((F.col(f"{prefix}{f}") - F.lit(means[f"{prefix}{f}"])) * F.lit(w), digits)
        for f, w in weights.items()
    }


def fitted_impacts(model: PipelineModel) -> tuple[float, dict[str, Column]]:
    """(intercept, source column -> its part of the log-odds) of a fitted logistic model.

    A source column is what the model was trained on, derived features included: scale, flag and category slots
    of one column are one sum. With the intercept the parts add up to the log-odds of the model.
    """
    steps = {type(s): s for s in model.stages}
    if PreparedColumns not in steps or LogisticRegressionModel not in steps:
        raise ExplanationError("exact contributions need a fitted preparation and a logistic model")
    linear = steps[LogisticRegressionModel]
    parts: dict[str, Column] = {}
    for (source, value), weight in zip(steps[PreparedColumns].slots(), linear.coefficients.toArray().tolist(), strict=True):
        term = value * F.lit(weight)
        parts[source] = parts[source] + term if source in parts else term
    return linear.intercept, parts


def explain_fitted(model: PipelineModel, df: DataFrame, column: str = "explanation") -> DataFrame:
    """Append the ranked contributions of a fitted logistic model: one projection, no second transform."""
    _, parts = fitted_impacts(model)
    named = {f: f"_impact {i}" for i, f in enumerate(parts)}
    rows = add_derived_features(df).select(*df.columns, *[parts[f].alias(n) for f, n in named.items()])
    return rows.select(*df.columns, ranked({f: F.col(f"`{n}`") for f, n in named.items()}).alias(column))


def ranked(impacts: dict[str, Column]) -> Column:
    """``array<struct<feature, impact, direction>>`` by falling \\|impact\\|, ties by name."""
    keyed = F.array(
        *[
            F.struct(
                (-F.abs(c)).alias("k"),
                F.lit(f).alias("feature"),
                c.alias("impact"),
                direction(c).alias("direction"),
            )
            for f, c in impacts.items()
        ]
    )
    return F.transform(
        F.array_sort(keyed),
        lambda e: F.struct(
            e["feature"].alias("feature"), e["impact"].alias("impact"), e["direction"].alias("direction")
        ),
    )


def top_contributors(df: DataFrame, k: int, column: str = "explanation") -> DataFrame:
    """Keep the k strongest contributions of every row."""
    return df.withColumn(column, F.slice(column, 1, k))


def global_importance(df: DataFrame, impacts: dict[str, Column]) -> DataFrame:
    """Mean absolute impact per feature and its rank: one pass, one row per feature."""
    wide = df.agg(*[F.avg(F.abs(c)).alias(f) for f, c in impacts.items()])
    rows = wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f).alias("feature"), F.round(F.col(f), 6).alias("importance"))
                    for f in impacts
                ]
            )
        )
    )
    return rows.orderBy(F.col("importance").desc(), "feature")


#: The background is numbered in so many slices of its hashes, whose sizes reach the driver.
SLICES = 1024


def _numbered(background: DataFrame, features: Sequence[str], seed: int) -> tuple[DataFrame, int]:
    """(_place, _other) of all background rows, numbered from 0 in the order of slice, hash and values; and their number."""
    marked = background.select(F.struct(*features).alias("_other"), F.xxhash64(F.lit(seed), *features).alias("_h"))
    marked = marked.withColumn("_slice", F.pmod("_h", F.lit(SLICES)).cast("int"))
    sizes = {r["_slice"]: r["count"] for r in marked.groupBy("_slice").count().collect()}
    if not sizes:
        raise ExplanationError("the background table is empty")
    starts, total = [], 0
    for i in range(SLICES):
        starts.append(total)
        total += sizes.get(i, 0)
    before = F.get(F.lit(starts).cast("array<bigint>"), F.col("_slice"))
    place = F.row_number().over(Window.partitionBy("_slice").orderBy("_h", "_other")) - 1
    return marked.select((before + place).alias("_place"), "_other"), total


def sampled_shapley(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    background: DataFrame,
    permutations: int = 8,
    seed: int = SEED,
) -> DataFrame:
    """Shapley values by seeded permutation sampling, for any model with a probability.

    ``score`` adds a double column ``p`` to a table that has the features. Every
    row walks ``permutations`` feature orders; each walk starts from a background
    row and switches one feature after another to the row's own value, and the
    change of ``p`` is that feature's contribution. Along one walk the changes
    add up to ``p(row) - p(background row)`` exactly.

    All walks are rows of one DataFrame, so the model runs once over the whole
    set: ``permutations * (features + 1)`` scorings per row. The background is the
    whole table; each walk draws its row by a hash of key and walk, through a join.
    Explained rows are never grouped beyond their own walks.

    Returns key, feature, impact, direction.
    """
    features = list(features)
    types = dict(background.dtypes)
    pool, total = _numbered(background, features, seed)
    draw = random.Random(seed)
    orders = []
    for _ in range(permutations):
        order = list(range(len(features)))
        draw.shuffle(order)
        orders.append(order)
    # walks[w].at[j] = step at which feature j switches to the row's own value.
    walks = F.array(
        *[
            F.struct(
                F.lit(w).alias("w"),
                F.array(*[F.lit(order.index(j) + 1) for j in range(len(features))]).alias("at"),
            )
            for w, order in enumerate(orders)
        ]
    )
    walked = (
        df.select(key, F.struct(*[F.col(f).cast(types[f]).alias(f) for f in features]).alias("_own"))
        .withColumn("_walk", F.explode(walks))
        .withColumn("_place", F.pmod(F.xxhash64(key, "_walk.w", F.lit(seed)), F.lit(total).cast("bigint")))
        .join(pool, "_place")
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    )
    mixed = walked.select(
        key,
        F.col("_walk.w").alias("_w"),
        F.col("_walk.at").alias("_at"),
        "_step",
        *[
            F.when(F.get(F.col("_walk.at"), F.lit(j)) <= F.col("_step"), F.col(f"_own.{f}"))
            .otherwise(F.col(f"_other.{f}"))
            .alias(f)
            for j, f in enumerate(features)
        ],
    )
    # The change at step s belongs to the feature switched at s: p there counts
    # plus for that feature and minus for the one switched next.
    last = len(features)
    named = F.array(*[F.lit(f) for f in features])
    plus = F.struct(
        F.get(named, (F.array_position("_at", F.col("_step")) - 1).cast("int")).alias("feature"),
        F.col("p").alias("change"),
    )
    minus = F.struct(
        F.get(named, (F.array_position("_at", F.col("_step") + 1) - 1).cast("int")).alias("feature"),
        (-F.col("p")).alias("change"),
    )
    terms = F.array_compact(
        F.array(F.when(F.col("_step") > 0, plus), F.when(F.col("_step") < last, minus))
    )
    scored = score(mixed)
    return (
        scored.select(
            key,
            F.explode(terms).alias("t"),
        )
        .groupBy(key, F.col("t.feature").alias("feature"))
        .agg((F.sum("t.change") / permutations).alias("impact"))
        .withColumn("direction", direction("impact"))
    )
