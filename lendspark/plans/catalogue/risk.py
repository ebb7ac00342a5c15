"""Score, level, explanation, registry changes; the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendspark.operators import explain
from lendspark.operators import monitor as mon
from lendspark.operators import registry as reg
from lendspark.operators.registry import model_rows
from lendspark.plans.catalogue.base import METADATA, SCORED, metadata, query, scored
from lendspark.plans.catalogue.common import EXPLAINED, explained, with_impacts
from lendspark.plans.catalogue.validation import registry_rows
from lendspark.plans.scoring import prediction_rows, with_risk


@query(f"""
WITH {SCORED}
SELECT risk_level, count(*) AS n, round(count(*) / (SELECT count(*) FROM risk), 6) AS share FROM risk
GROUP BY risk_level
""")
def risk_distribution(spark, sf_dir):
    """Check, derive, score, bucket, count."""
    return mon.risk_distribution(with_risk(scored(spark, sf_dir)))


@query(f"""
WITH {SCORED}
SELECT application_id AS request, p AS default_probability, risk_score, risk_level, '1.0.0' AS prediction_version,
  sha256(sha256('scorecard|1.0.0') || '|' || application_id) AS id
FROM risk
""")
def risk_score_level(spark, sf_dir):
    rows = prediction_rows(scored(spark, sf_dir), "scorecard", "1.0.0")
    return rows.select(
        F.col("request_id").cast("bigint").alias("request"),
        "default_probability",
        "risk_score",
        "risk_level",
        "prediction_version",
        "id",
    )


RANKED = EXPLAINED + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY application_id ORDER BY abs(impact) DESC, feature) AS place,
    CASE WHEN impact >= 0 THEN 'positive' ELSE 'negative' END AS direction
  FROM impacts)"""


@query(f"WITH {RANKED} SELECT application_id, CAST(place AS INTEGER) AS place, feature, impact, direction FROM placed")
def linear_contributions(spark, sf_dir):
    rows = explained(spark, sf_dir).select("application_id", F.posexplode("explanation").alias("i", "e"))
    return rows.select("application_id", (F.col("i") + 1).alias("place"), "e.*")


@query(f"WITH {RANKED} SELECT application_id, feature, impact FROM placed WHERE place <= 2")
def top_contributors(spark, sf_dir):
    rows = explain.top_contributors(explained(spark, sf_dir), 2)
    return rows.select("application_id", F.inline("explanation")).drop("direction")


@query(f"WITH {EXPLAINED} SELECT feature, round(avg(abs(impact)), 6) AS importance FROM impacts GROUP BY feature")
def global_importance(spark, sf_dir):
    rows, impacts = with_impacts(spark, sf_dir)
    return explain.global_importance(rows, impacts)


@query(f"WITH {METADATA} SELECT name, version, part = 52 AS is_active FROM metadata")
def activate_model(spark, sf_dir):
    """One write activates one model and deactivates the one before."""
    changed = reg.activate(registry_rows(spark, sf_dir), "scorecard-12", "1.0.0")
    return changed.select("name", "version", "is_active")


@query(f"""
WITH {METADATA}
SELECT name, version, trained_at, algorithm FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY trained_at DESC, version DESC) AS rn FROM metadata)
WHERE rn = 1
""")
def latest_version(spark, sf_dir):
    rows = reg.latest_versions(model_rows(metadata(spark, sf_dir)))
    return rows.select("name", "version", "trained_at", "algorithm")
