"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bindings import QUERIES  # noqa: E402
from riskloom.session import get_session  # noqa: E402

HEADLINE = [
    "engineer",
    "row_errors",
    "batch_verdict",
    "batch_response",
    "stratified_split",
    "impute_scale",
    "prepare",
    "describe",
    "percentiles",
    "duplicate_rows",
    "conflict_target",
    "binary_metrics",
    "roc_auc",
    "performance",
    "psi",
    "ks",
    "wasserstein",
    "corr_spearman",
    "dataset_drift",
    "dq_tests",
    "fairness",
    "prediction_summary",
    "monitor_status",
    "monitor",
    "logistic_regression",
    "windowed_summary",
    "windowed_psi",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    conf = {"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.driver.memory": "8g"}
    spark = get_session("bench", f"local[{cpus}]", conf)
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)  # warm-up: class loading and code generation
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 4)
    print(
        json.dumps(
            {
                "metric": "total_warm_median_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
