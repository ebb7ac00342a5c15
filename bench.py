"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lendspark.plans.catalogue import QUERIES  # noqa: E402
from lendspark.session import build_session  # noqa: E402

HEADLINE = (
    "risk_distribution",
    "risk_score_level",
    "row_violations",
    "rule_counts",
    "quarantine_split",
    "prior_history",
    "derived_features",
    "customer_loans",
    "null_profile",
    "numeric_profile",
    "distinct_counts",
    "duplicates",
    "outliers_iqr",
    "stratified_split",
    "fold_ids",
    "time_split",
    "evaluation_report",
    "fold_metrics",
    "threshold_sweep",
    "calibration_curve",
    "linear_contributions",
    "global_importance",
    "prediction_model",
    "latency_stats",
    "psi_numeric",
    "psi_categorical",
    "prediction_drift",
    "performance_by_month",
    "json_batch_explode",
    "stream_score",
    "fit_logistic",
    "fit_boosted",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory="12g",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["risk_distribution"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "applications_per_sec": {n: round(rows / s) for n, s in seconds.items()},
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
