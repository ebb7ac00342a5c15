"""Metrics over the scored view."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendspark.operators import metrics as met
from lendspark.operators.split import stratified_folds
from lendspark.plans.catalogue.base import SCORED, query, scored, settled, settled_sql
from lendspark.plans.catalogue.preparation import FOLDS
from lendspark.session import stored

AUC = """
by_score AS (
  SELECT {by} p, sum(loan_status) AS pos, sum(1 - loan_status) AS neg FROM {rows} GROUP BY {by} p),
ranked AS (
  SELECT *, coalesce(sum(neg) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
    sum(pos) OVER (v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    sum(pos + neg) OVER (v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k
  FROM by_score WINDOW w AS ({part} ORDER BY p), v AS ({part} ORDER BY p DESC)),
ranking AS (
  SELECT {by} sum(pos * (neg_below + neg / 2.0::DOUBLE)) / nullif(sum(pos) * sum(neg), 0) AS roc_auc,
    sum(pos * (CAST(tp AS DOUBLE) / k)) / nullif(sum(pos), 0) AS pr_auc
  FROM ranked {group}),
counted AS (
  SELECT {by} CAST(count(*) FILTER (WHERE p >= 0.5 AND loan_status = 1) AS DOUBLE) AS tp,
    count(*) FILTER (WHERE p >= 0.5) AS k, sum(loan_status) AS pos,
    -avg(loan_status * ln(greatest(least(p, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE))
      + (1 - loan_status) * ln(1 - greatest(least(p, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE))) AS log_loss,
    avg((p - loan_status) * (p - loan_status)) AS brier_score
  FROM {rows} {group}),
plain AS (
  SELECT {by} tp / nullif(k, 0) AS precision, tp / nullif(pos, 0) AS recall,
    2 * tp / nullif(k + pos, 0) AS f1, log_loss, brier_score FROM counted)"""
WHOLE = SCORED + "," + AUC.format(by="", rows="scored", part="", group="")


METRICS = ("roc_auc", "pr_auc", "precision", "recall", "f1", "log_loss", "brier_score")


def shown(*names: str) -> str:
    return ", ".join(f"{settled_sql(n)} AS {n}" for n in names)


def grouped(by: str, rows: str) -> str:
    return AUC.format(by=f"{by},", rows=rows, part=f"PARTITION BY {by}", group=f"GROUP BY {by}")


@query(f"WITH {WHOLE} SELECT {shown('roc_auc')} FROM ranking")
def roc_auc(spark, sf_dir):
    return settled(met.roc_auc(scored(spark, sf_dir)))


@query(f"WITH {WHOLE} SELECT {shown('pr_auc')} FROM ranking")
def average_precision(spark, sf_dir):
    return settled(met.average_precision(scored(spark, sf_dir)))


@query(f"""
WITH {SCORED}, s AS (
  SELECT CAST(sum(loan_status) FILTER (WHERE p >= 0.3) AS DOUBLE) AS tp, count(*) FILTER (WHERE p >= 0.3) AS k,
    sum(loan_status) AS pos FROM scored)
SELECT {settled_sql("tp / k")} AS precision, {settled_sql("tp / pos")} AS recall,
  {settled_sql("2 * tp / (k + pos)")} AS f1 FROM s
""")
def precision_recall_f1(spark, sf_dir):
    return settled(met.precision_recall_f1(scored(spark, sf_dir), threshold=0.3))


@query(f"WITH {WHOLE} SELECT {shown('log_loss')} FROM plain")
def log_loss(spark, sf_dir):
    return settled(met.log_loss(scored(spark, sf_dir)))


@query(f"WITH {WHOLE} SELECT {shown('brier_score')} FROM plain")
def brier(spark, sf_dir):
    return settled(met.brier_score(scored(spark, sf_dir)))


@query(f"""
WITH {SCORED}
SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, {settled_sql("avg(p)")} AS mean_p,
  {settled_sql("avg(loan_status)")} AS observed, count(*) AS n FROM scored GROUP BY 1
""")
def calibration_curve(spark, sf_dir):
    return settled(met.calibration_curve(scored(spark, sf_dir)))


@query(f"""
WITH {SCORED}
SELECT loan_status, CAST(p >= 0.3 AS INTEGER) AS predicted, count(*) AS n FROM scored GROUP BY ALL
""")
def confusion(spark, sf_dir):
    return met.confusion(scored(spark, sf_dir), threshold=0.3)


_GRID = tuple(i / 20 for i in range(1, 20))
SWEEP = SCORED + """,
sweep AS (
  SELECT t AS threshold, tp / nullif(k, 0) AS precision, tp / pos AS recall, 2 * tp / (k + pos) AS f1
  FROM (SELECT t, CAST(count(*) FILTER (WHERE p >= t AND loan_status = 1) AS DOUBLE) AS tp,
          count(*) FILTER (WHERE p >= t) AS k, sum(loan_status) AS pos
        FROM scored, (SELECT i / 20.0::DOUBLE AS t FROM range(1, 20) AS g(i)) GROUP BY t))"""


@query(f"WITH {SWEEP} SELECT threshold, {shown('precision', 'recall', 'f1')} FROM sweep")
def threshold_sweep(spark, sf_dir):
    return settled(met.threshold_sweep(scored(spark, sf_dir), thresholds=_GRID))


@query(f"WITH {SWEEP} SELECT threshold, {shown('f1')} FROM sweep ORDER BY sweep.f1 DESC, threshold LIMIT 1")
def best_threshold(spark, sf_dir):
    return settled(met.best_threshold(met.threshold_sweep(scored(spark, sf_dir), thresholds=_GRID)))


@query(f"""
WITH {FOLDS}, {grouped("fold", "folds")},
long AS (
  UNPIVOT (SELECT fold, roc_auc, pr_auc, f1, precision, recall, log_loss FROM ranking JOIN plain USING (fold))
  ON roc_auc, pr_auc, f1, precision, recall, log_loss INTO NAME metric VALUE v)
SELECT metric, {settled_sql('avg(v)')} AS mean, {settled_sql('stddev_samp(v)')} AS stddev, count(v) AS folds FROM long
GROUP BY metric
""")
def fold_metrics(spark, sf_dir):
    rows = stored(scored(spark, sf_dir).select("application_id", "loan_status", "p"), "scored")
    rows = stored(stratified_folds(rows, "application_id").select("fold", "loan_status", "p"), "folds")
    return settled(met.fold_metrics(rows))


@query(f"WITH {WHOLE} SELECT {shown(*METRICS)} FROM ranking, plain")
def evaluation_report(spark, sf_dir):
    return settled(met.evaluation_report(scored(spark, sf_dir)))
