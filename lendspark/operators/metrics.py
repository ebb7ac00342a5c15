"""Model evaluation over (label, probability) tables.

Everything but plain averages is computed from a score table: one row per
distinct score with its positives and negatives. Counting collapses ties before
the shuffle, and ordered sums run over distinct scores in even parts.

Every metric is over the rows that have a score (not NULL, not NaN) and a label of
0 or 1; ``unscored`` says how many others there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.operators.running import running_totals, value_edges
from lendspark.schemas import PROBABILITY_CLIP, TARGET, THRESHOLDS


def _has_score(p: str) -> str:
    return f"({p} IS NOT NULL AND NOT isnan(CAST({p} AS DOUBLE)))"


def with_score(df: DataFrame, label: str = TARGET, p: str = "p") -> DataFrame:
    """The rows that metrics are about."""
    return df.where(f"{_has_score(p)} AND {label} IN (0, 1)")


def unscored(df: DataFrame, label: str = TARGET, p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Rows in all, without a score, and with a score but no label of 0 or 1; per group if asked."""
    return df.groupBy(*by).agg(
        F.expr("count(1) AS n"),
        F.expr(f"count_if(NOT {_has_score(p)}) AS n_without_score"),
        F.expr(f"count_if({_has_score(p)} AND NOT coalesce({label} IN (0, 1), false)) AS n_without_label"),
    )


def score_table(
    df: DataFrame, label: str = TARGET, p: str = "p", by: Sequence[str] = ()
) -> DataFrame:
    return with_score(df, label, p).groupBy(*by, F.col(p).alias("score")).agg(
        F.expr(f"count_if({label} = 1) AS pos"), F.expr(f"count_if({label} = 0) AS neg")
    )


def _ranked(df: DataFrame, label: str, p: str, by: Sequence[str], edges) -> DataFrame:
    if edges is None:
        edges = value_edges(df, p)
    return running_totals(score_table(df, label, p, by), "score", ["pos", "neg"], by, edges)


#: Share of (positive, negative) pairs in the right order, ties counted half.
ROC_AUC = """try_divide(sum(pos * (neg_below + neg / 2D)),
  CAST(max(pos_total) AS DOUBLE) * max(neg_total))"""
#: Precision at each score that adds recall, weighted by the recall it adds.
AVERAGE_PRECISION = """try_divide(
  sum(pos * ((pos_total - pos_below) / (pos_total - pos_below + neg_total - neg_below))),
  CAST(max(pos_total) AS DOUBLE))"""
BRIER = "try_divide(sum(pos * (1D - score) * (1D - score) + neg * score * score), sum(pos + neg))"
_CLIPPED = f"greatest(least(score, 1D - {PROBABILITY_CLIP}D), {PROBABILITY_CLIP}D)"
LOG_LOSS = f"try_divide(-sum(pos * ln({_CLIPPED}) + neg * ln(1D - {_CLIPPED})), sum(pos + neg))"


def _count_metrics(threshold: float) -> dict[str, str]:
    """Precision, recall and F1 when scores from ``threshold`` up count as positive."""
    above = f"FILTER (WHERE score >= {float(threshold)}D)"
    tp = f"CAST(coalesce(sum(pos) {above}, 0) AS DOUBLE)"
    picked = f"CAST(coalesce(sum(pos + neg) {above}, 0) AS DOUBLE)"
    return {
        "precision": f"try_divide({tp}, {picked})",
        "recall": f"try_divide({tp}, CAST(sum(pos) AS DOUBLE))",
        "f1": f"try_divide({tp} * 2D, {picked} + sum(pos))",
    }


def _summary(table: DataFrame, by: Sequence[str], cols: dict[str, str]) -> DataFrame:
    return table.groupBy(*by).agg(*[F.expr(f"{c} AS {n}") for n, c in cols.items()])


def roc_auc(df, label: str = TARGET, p: str = "p", by: Sequence[str] = (), edges=None) -> DataFrame:
    return _summary(_ranked(df, label, p, by, edges), by, {"roc_auc": ROC_AUC})


def average_precision(
    df, label: str = TARGET, p: str = "p", by: Sequence[str] = (), edges=None
) -> DataFrame:
    return _summary(_ranked(df, label, p, by, edges), by, {"pr_auc": AVERAGE_PRECISION})


def precision_recall_f1(
    df, label: str = TARGET, p: str = "p", by: Sequence[str] = (), threshold: float = 0.5
) -> DataFrame:
    return _summary(score_table(df, label, p, by), by, _count_metrics(threshold))


def log_loss(df, label: str = TARGET, p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    return _summary(score_table(df, label, p, by), by, {"log_loss": LOG_LOSS})


def brier_score(df, label: str = TARGET, p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    return _summary(score_table(df, label, p, by), by, {"brier_score": BRIER})


def evaluation_report(
    df,
    label: str = TARGET,
    p: str = "p",
    by: Sequence[str] = (),
    threshold: float = 0.5,
    edges=None,
) -> DataFrame:
    """All seven metrics, one row per group, from a single reduction of the data."""
    return _summary(
        _ranked(df, label, p, by, edges),
        by,
        {
            "roc_auc": ROC_AUC,
            "pr_auc": AVERAGE_PRECISION,
            **_count_metrics(threshold),
            "log_loss": LOG_LOSS,
            "brier_score": BRIER,
        },
    )


def calibration_curve(
    df, label: str = TARGET, p: str = "p", bins: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """Mean probability and observed rate per equal-width bin."""
    slot = F.expr(f"CAST(least(floor({p} * {float(bins)}D), {bins - 1}) AS INT) AS bin")
    return with_score(df, label, p).groupBy(*by, slot).agg(
        F.expr(f"avg({p}) AS mean_p"),
        F.expr(f"avg(CAST({label} AS DOUBLE)) AS observed"),
        F.expr("count(1) AS n"),
    )


def confusion(df, label: str = TARGET, p: str = "p", threshold: float = 0.5) -> DataFrame:
    predicted = (F.col(p) >= threshold).cast("int").alias("predicted")
    return with_score(df, label, p).groupBy(F.col(label), predicted).agg(F.count(F.lit(1)).alias("n"))


def threshold_sweep(
    df,
    label: str = TARGET,
    p: str = "p",
    thresholds: Sequence[float] = THRESHOLDS,
) -> DataFrame:
    """Precision, recall and F1 per threshold: one pass, no copy of the rows per threshold."""
    wide = with_score(df, label, p).agg(
        F.expr(f"count_if({label} = 1) AS pos"),
        *[
            F.expr(f"count_if({p} >= {float(t)}D AND {label} = 1) AS tp{i}")
            for i, t in enumerate(thresholds)
        ],
        *[F.expr(f"count_if({p} >= {float(t)}D) AS picked{i}") for i, t in enumerate(thresholds)],
    )
    rows = ", ".join(f"{float(t)}D, tp{i}, picked{i}, pos" for i, t in enumerate(thresholds))
    return wide.selectExpr(
        f"stack({len(thresholds)}, {rows}) AS (threshold, tp, picked, pos)"
    ).selectExpr(
        "threshold",
        "try_divide(CAST(tp AS DOUBLE), picked) AS precision",
        "try_divide(CAST(tp AS DOUBLE), pos) AS recall",
        "try_divide(tp * 2D, picked + pos) AS f1",
    )


def best_threshold(sweep: DataFrame, objective: str = "f1") -> DataFrame:
    """The threshold with the best objective; the lowest of equals."""
    order = F.struct(F.col(objective), -F.col("threshold"))
    return sweep.agg(
        F.max_by("threshold", order).alias("threshold"), F.max(objective).alias(objective)
    )


FOLD_METRICS = ("roc_auc", "pr_auc", "f1", "precision", "recall", "log_loss")


def fold_metrics(df, label: str = TARGET, p: str = "p", fold: str = "fold") -> DataFrame:
    """Metrics per fold, summarised as mean and sample deviation per metric."""
    report = evaluation_report(df, label, p, [fold])
    rows = ", ".join(f"'{m}', {m}" for m in FOLD_METRICS)
    return (
        report.selectExpr(f"stack({len(FOLD_METRICS)}, {rows}) AS (metric, value)")
        .groupBy("metric")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("stddev"),
            F.count("value").alias("folds"),
        )
    )
