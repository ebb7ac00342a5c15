"""Preprocessing, training, search, calibration and comparison with Spark ML."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.functions.features import DERIVED, DERIVED_SQL, DerivedFeatures
from lendspark.operators.metrics import evaluation_report, roc_auc
from lendspark.operators.profile import add_class_weight
from lendspark.operators.registry import ArtifactMetadata
from lendspark.operators.running import order_statistics
from lendspark.plans import boosting
from lendspark.plans.prepare import PrepareColumns, PreparedColumns
from lendspark.plans.scoring import model_score
from lendspark.schemas import FORBIDDEN_FEATURES, SEED, TARGET
from lendspark.session import scratch_path, stored

NUMERIC = (
    "age",
    "income",
    "employment_years",
    "loan_amount",
    "interest_rate",
    "term_months",
    "credit_history_years",
    "late_payments",
    "previous_defaults",
    "credit_utilization",
    "active_credit_lines",
)
CATEGORICAL = ("home_ownership", "loan_intent", "loan_grade")

#: Starting parameters of the primary model (fixed values).
BOOSTED_START = {
    "n_estimators": 300,
    "max_depth": 5,
    "learning_rate": 0.05,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
}
#: Search parameter -> Spark ML parameter of the boosted trees.
BOOSTED_PARAMS = {
    "n_estimators": "maxIter",
    "max_depth": "maxDepth",
    "learning_rate": "stepSize",
    "min_child_weight": "minInstancesPerNode",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "gamma": "minInfoGain",
}
SEARCH_SPACE = {
    "n_estimators": (100, 200, 300),
    "max_depth": (3, 4, 5, 6),
    "learning_rate": (0.02, 0.05, 0.1),
    "min_child_weight": (1, 5, 10),
    "subsample": (0.7, 0.8, 1.0),
    "colsample_bytree": (0.7, 0.8, 1.0),
    "gamma": (0.0, 0.001, 0.01),
}


# ------------------------------------------------------------- column form (exact)
def missing_flags(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{c}_was_missing": F.col(c).isNull().cast("int") for c in columns}


def fit_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians of the training rows."""
    found = order_statistics(train, {c: (0.5,) for c in columns})
    return {c: found[c][0.5] for c in columns}


def impute_with_flags(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Fill NULLs with the given medians and say so in ``<column>_was_missing``."""
    flags = missing_flags(list(medians))
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()}
    return df.withColumns(flags).withColumns(filled)


def fit_scale(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample deviation of the training rows."""
    row = train.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def scale_standard(df: DataFrame, scale: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {
            f"{c}_scaled": F.try_divide(F.col(c).cast("double") - F.lit(m), F.lit(s))
            for c, (m, s) in scale.items()
        }
    )


def one_hot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """0 / 1 columns per known value; an unknown value is 0 everywhere."""
    return df.withColumns(
        {
            f"{column}_{v.lower()}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0))
            for v in values
        }
    )


# -------------------------------------------------------------------- Spark ML form
def preprocessing(
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    derived: Sequence[str] = DERIVED,
) -> list:
    """Stages from raw application columns to ``features``.

    Derived features come first, so they are part of the saved model. Everything
    that learns (which columns hold values, medians, scale, categories) does so when
    the stages are fit, that is on training rows only.
    """
    leaked = set(FORBIDDEN_FEATURES) & {*numeric, *categorical, *derived}
    if leaked:
        raise ValueError(f"columns that a model must not see: {', '.join(sorted(leaked))}")
    return [DerivedFeatures(), PrepareColumns(numeric=[*numeric, *derived], categorical=list(categorical))]


def prepared(model: PipelineModel) -> PreparedColumns:
    """The fitted preparation inside a model."""
    return next(s for s in model.stages if isinstance(s, PreparedColumns))


def input_types(model: PipelineModel, df: DataFrame) -> dict[str, str]:
    """Column -> type of what the model reads from ``df``, the table it was trained on."""
    needs = {c for name in prepared(model).decided["types"] for c in DERIVED_SQL.get(name, ((name,),))[0]}
    return {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name in needs}


def logistic(weight: str | None = None, **params) -> LogisticRegression:
    est = LogisticRegression(labelCol=TARGET, featuresCol="features", maxIter=50, regParam=0.001)
    est = est.setWeightCol(weight) if weight else est
    return est.setParams(**params) if params else est


def forest(weight: str | None = None, **params) -> RandomForestClassifier:
    est = RandomForestClassifier(labelCol=TARGET, featuresCol="features", seed=SEED)
    est = est.setWeightCol(weight) if weight else est
    return est.setParams(**params) if params else est


def boosted(weight: str | None = None, **params) -> GBTClassifier:
    """Boosted trees, by the usual parameter names (``BOOSTED_PARAMS``)."""
    chosen = {BOOSTED_PARAMS[k]: v for k, v in {**BOOSTED_START, **params}.items()}
    chosen["featureSubsetStrategy"] = _subset(chosen["featureSubsetStrategy"])
    est = GBTClassifier(labelCol=TARGET, featuresCol="features", seed=SEED, **chosen)
    return est.setWeightCol(weight) if weight else est


def _subset(share: float) -> str:
    return "all" if float(share) >= 1.0 else str(share)


def train(df: DataFrame, estimator: Estimator, weighted: bool = False, **stages) -> PipelineModel:
    """Fit preprocessing and model as one artifact on training rows.

    Trees read their rows several times before the first one grows, so for them the feature vectors are stored.
    Boosted trees are grown by ``boosting.fit``.
    """
    rows = add_class_weight(df, TARGET, "weight") if weighted else df
    if not isinstance(estimator, (GBTClassifier, RandomForestClassifier)):
        return Pipeline(stages=[*preprocessing(**stages), estimator]).fit(rows)
    prepare = Pipeline(stages=preprocessing(**stages)).fit(rows)
    reads = [estimator.getFeaturesCol(), estimator.getLabelCol()]
    if estimator.isDefined("weightCol"):
        reads.append(estimator.getWeightCol())
    matrix = stored(prepare.transform(rows).select(*reads), "matrix")
    fitted = boosting.fit(estimator, matrix) if isinstance(estimator, GBTClassifier) else estimator.fit(matrix)
    return PipelineModel([*prepare.stages, fitted])


def evaluate(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Metrics of the model on ``df``; the scores are stored, since the report reads them more than once."""
    scores = stored(model_score(model)(df).select(TARGET, "p"), "scores")
    return evaluation_report(scores, threshold=threshold)


def train_model(
    df: DataFrame,
    dataset_version: str,
    estimator: Estimator | None = None,
    holdout: DataFrame | None = None,
    name: str = "loan-default-boosted",
    version: str = "1.0.0",
    feature_version: str = "v1",
    weighted: bool = False,
) -> tuple[PipelineModel, ArtifactMetadata]:
    """Fit the primary model and describe the run; metrics come from ``holdout``."""
    estimator = estimator or boosted("weight" if weighted else None)
    model = train(df, estimator, weighted)
    metrics = {}
    if holdout is not None:
        row = evaluate(model, holdout).first().asDict()
        metrics = {k: v for k, v in row.items() if v is not None}
    meta = ArtifactMetadata(
        name=name,
        version=version,
        algorithm=type(estimator).__name__,
        dataset_version=dataset_version,
        feature_version=feature_version,
        metrics=metrics,
        trained_at=datetime.now(timezone.utc).replace(microsecond=0),
        columns=input_types(model, df),
    )
    return model, meta


def draw_candidates(space: dict[str, Sequence], trials: int, seed: int = SEED) -> list[dict]:
    """Seeded random draws without repetition."""
    rng = random.Random(seed)
    seen, out = set(), []
    most = 1
    for values in space.values():
        most *= len(values)
    while len(out) < min(trials, most):
        pick = {k: rng.choice(list(v)) for k, v in space.items()}
        mark = tuple(sorted(pick.items()))
        if mark not in seen:
            seen.add(mark)
            out.append(pick)
    return out


#: Rows that one task of a fit holds; a fit over fewer partitions has shorter jobs for each level of each tree.
ROWS_PER_TASK = 50_000


def _fold_matrix(df: DataFrame, fold: str, k) -> tuple[DataFrame, DataFrame]:
    """(rows to fit on, held-out rows) of a fold as stored feature vectors; preparation is fitted on the other folds."""
    spark = df.sparkSession
    prepare = Pipeline(stages=preprocessing()).fit(df.where(F.col(fold) != k))
    path = scratch_path(spark, "search-fold")
    columns = ["features", TARGET, (F.col(fold) == k).alias("held_out")]
    prepare.transform(df.where(F.col(fold).isNotNull())).select(*columns).write.parquet(path)
    matrix = spark.read.parquet(path)
    tasks = -(-matrix.count() // ROWS_PER_TASK)
    return tuple(matrix.where(rows).coalesce(max(1, tasks)) for rows in ("NOT held_out", "held_out"))


def search(
    df: DataFrame,
    fold: str = "fold",
    trials: int = 10,
    space: dict[str, Sequence] | None = None,
    parallelism: int = 8,
    seed: int = SEED,
    fixed: dict | None = None,
    keep: float = 1.0,
) -> DataFrame:
    """Cross-validated random search over boosted trees: (candidate, parameters, folds, and the mean of each metric).

    Candidates are fitted on each fold's feature vectors, which are stored once; no fold sees another fold's
    medians, scale or categories. A fit is a job of its own, of one task up to ``boosting.FIT_ROWS`` rows, and as many
    run side by side as there is room for. Held-out scores are stored, and one report over all of them gives the metrics.
    After each fold the best share ``keep`` of the candidates still in the race, by mean ROC-AUC so far, goes on to
    the next (two at least); 1.0 takes every candidate through every fold, and ``folds`` says how many each had.
    ``best_candidate`` picks by ROC-AUC. Folds come from ``stratified_folds``.
    """
    spark = df.sparkSession
    picks = [{**(fixed or {}), **pick} for pick in draw_candidates(space or SEARCH_SPACE, trials, seed)]
    scores = scratch_path(spark, "search-scores")

    def prepare(k) -> tuple:
        fit_on, held_out = _fold_matrix(df, fold, k)
        est = boosted(**(fixed or {}))
        found = boosting.thresholds(est, fit_on)
        return fit_on, held_out, found, stored(boosting.blocks(est, fit_on, found), "blocks"), boosting.tasks_of_a_fit(fit_on)

    def run(candidate: int, k, fit_on: DataFrame, held_out: DataFrame, found: list, blocks: DataFrame, tasks: int) -> None:
        est = boosted(**picks[candidate])
        if boosting.supported(est, fit_on, tasks):
            grown = boosting.trees(blocks, boosting.specification(est, found), tasks)
            out = boosting.scored(held_out, est, found, grown)
        else:
            p = F.get(vector_to_array("probability"), F.lit(1)).alias("p")
            out = est.fit(fit_on).transform(held_out).select(TARGET, p)
        out.write.parquet(f"{scores}/candidate={candidate}/fold={k}")

    def size(candidate: int) -> float:
        est = boosted(**picks[candidate])
        return -est.getMaxIter() * est.getMaxDepth()

    schema = f"{TARGET} int, p double, candidate int, fold string"
    alive = sorted(range(len(picks)), key=size)
    folds = sorted(r[0] for r in df.select(fold).where(F.col(fold).isNotNull()).distinct().collect())
    with ThreadPoolExecutor(parallelism) as pool:
        parts = dict(zip(folds, pool.map(prepare, folds), strict=True))
    most = max((p[-1] for p in parts.values()), default=1)
    with ThreadPoolExecutor(max(1, min(parallelism, boosting.slots(df) // most))) as pool:
        for turn in [[k] for k in folds] if keep < 1 else [folds]:
            for done in [pool.submit(run, i, k, *parts[k]) for i in alive for k in turn]:
                done.result()
            if keep < 1:
                so_far = roc_auc(spark.read.schema(schema).parquet(scores), by=["candidate", "fold"])
                order = {r[0]: r[1] or 0.0 for r in so_far.groupBy("candidate").agg(F.avg("roc_auc")).collect()}
                alive = sorted(alive, key=lambda i: (-order[i], i))[: max(2, math.ceil(keep * len(alive)))]
    metrics = ("roc_auc", "pr_auc", "f1", "precision", "recall", "log_loss", "brier_score")
    report = evaluation_report(spark.read.schema(schema).parquet(scores), by=["candidate", "fold"])
    means = report.groupBy("candidate").agg(F.count("roc_auc").cast("int").alias("folds"), *[F.avg(m).alias(m) for m in metrics])
    rows = [(i, {k: float(v) for k, v in {**BOOSTED_START, **pick}.items()}) for i, pick in enumerate(picks)]
    return spark.createDataFrame(rows, "candidate int, parameters map<string,double>").join(F.broadcast(means), "candidate", "left")


def best_candidate(found: DataFrame, metric: str = "roc_auc") -> dict[str, float]:
    """Parameters of the candidate with the best mean metric among those with the most folds; the first of equals."""
    most = found.agg(F.max("folds")).first()[0]
    best = found.where((F.col("folds") == most) & F.col(metric).isNotNull()).agg(F.max_by("parameters", F.struct(metric, -F.col("candidate"))))
    return best.first()[0]


def comparison(models: dict[str, PipelineModel], holdout: DataFrame) -> DataFrame:
    """One evaluation row per model on the same rows."""
    out = None
    for name, model in models.items():
        row = evaluate(model, holdout).select(F.lit(name).alias("model"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def best_model(table: DataFrame, metric: str = "roc_auc") -> DataFrame:
    return table.agg(F.max_by("model", metric).alias("model"), F.max(metric).alias(metric))


def calibrate(model: PipelineModel, validation: DataFrame, digits: int = 4) -> PipelineModel:
    """Append isotonic calibration, fit on validation scores, as a stage of the model.

    Scores are first averaged on a grid of ``10^digits + 1`` points: the last step
    of the isotonic fit runs on one machine, and this bounds what reaches it.
    """
    p = F.round("p", digits).alias("p")
    grid = (
        model_score(model)(validation)
        .groupBy(p)
        .agg(F.avg(F.col(TARGET).cast("double")).alias("y"), F.count(F.lit(1)).cast("double").alias("w"))
    )
    fitted = IsotonicRegression(
        featuresCol="p", labelCol="y", weightCol="w", predictionCol="calibrated"
    ).fit(grid)
    fitted = fitted.setFeaturesCol("probability").setFeatureIndex(1)
    return PipelineModel([*model.stages, fitted])
