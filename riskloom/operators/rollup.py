"""Monitoring roll-up (ROL rows): status, alerts, retraining, dashboard.

A *results* frame has one row per monitoring run with ``drift_share``,
``failed_tests``, ``passed_tests``, ``total_tests``, ``accuracy``, ``f1`` and
``parity`` (map of sensitive feature to parity difference). NULL means the
section did not run and takes the documented default. Every function is a
projection, so it works the same on one run, a history table or a stream.

``mode='last_write'`` lets a later check overwrite an earlier status (the
compatible behaviour); ``'max_severity'`` keeps the most severe one.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.config import AdviceThresholds, MonitorThresholds, RetrainThresholds
from riskloom.session import as_datetime

log = logging.getLogger(__name__)


def _metric(name: str, default: float) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(float(default)))


def _biased(limit: float) -> Column:
    """Names of the sensitive features whose parity difference is above the limit."""
    entries = F.array_sort(F.map_entries(F.col("parity")))
    hit = F.filter(entries, lambda e: e["value"] > F.lit(limit))
    return F.coalesce(F.transform(hit, lambda e: e["key"]), F.array().cast("array<string>"))


def _messages(fixed: list[tuple[Column, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(test, text) for test, text in fixed]))


def _bias_messages(names: Column) -> Column:
    return F.transform(names, lambda n: F.concat(F.lit("Bias detected in "), n))


def _check_mode(mode: str) -> None:
    if mode not in ("last_write", "max_severity"):
        raise ValueError("mode must be 'last_write' or 'max_severity'")


def monitor_status(
    results: DataFrame, thresholds: MonitorThresholds = MonitorThresholds(), mode: str = "last_write"
) -> DataFrame:
    """Add ``monitoring_status`` and ``alerts``."""
    _check_mode(mode)
    drift = _metric("drift_share", 0) > thresholds.drift
    quality = _metric("failed_tests", 0) > thresholds.failed_tests
    weak = _metric("accuracy", 1) < thresholds.accuracy
    names = _biased(thresholds.parity)
    bias = F.size(names) > 0
    if mode == "last_write":
        status = (
            F.when(bias, F.lit("warning"))
            .when(weak, F.lit("critical"))
            .when(quality, F.lit("warning"))
            .when(drift, F.lit("alert"))
        )
    else:
        status = F.when(weak, F.lit("critical")).when(drift, F.lit("alert")).when(quality | bias, F.lit("warning"))
    failed = F.concat(F.lit("Data quality tests failed: "), F.col("failed_tests").cast("bigint").cast("string"))
    alerts = _messages(
        [
            (drift, F.lit("Data drift detected")),
            (quality, failed),
            (weak, F.lit("Model performance below threshold")),
        ]
    )
    return results.withColumns(
        {
            "monitoring_status": status.otherwise(F.lit("healthy")),
            "alerts": F.concat(alerts, _bias_messages(names)),
        }
    )


def retrain_decision(
    results: DataFrame, thresholds: RetrainThresholds = RetrainThresholds(), mode: str = "last_write"
) -> DataFrame:
    """Add ``retrain_needed``, ``retrain_reasons`` and ``priority``."""
    _check_mode(mode)
    drift = _metric("drift_share", 0) > thresholds.drift
    weak = _metric("accuracy", 1) < thresholds.accuracy
    weak_f1 = _metric("f1", 1) < thresholds.f1
    names = _biased(thresholds.parity)
    bias = F.size(names) > 0
    quality = _metric("failed_tests", 0) > thresholds.failed_tests
    if mode == "last_write":
        priority = F.when(weak_f1, F.lit("high")).when(weak, F.lit("critical")).when(drift, F.lit("high"))
    else:
        priority = F.when(weak, F.lit("critical")).when(weak_f1 | drift, F.lit("high"))
    priority = priority.when(bias | quality, F.lit("medium")).otherwise(F.lit("low"))
    head = _messages(
        [
            (drift, F.lit("High data drift detected")),
            (weak, F.lit("Model accuracy below threshold")),
            (weak_f1, F.lit("F1 score below threshold")),
        ]
    )
    tail = _messages([(quality, F.lit("Multiple data quality test failures"))])
    reasons = F.concat(head, _bias_messages(names), tail)
    return results.withColumns({"retrain_reasons": reasons, "priority": priority}).withColumn(
        "retrain_needed", F.size("retrain_reasons") > 0
    )


def retrain_request(decisions: DataFrame, requested_at, carry: list[str] = ()) -> DataFrame:
    """Rows to append to the request table: critical ones are immediate, the rest scheduled."""
    how = F.when(F.col("priority") == "critical", F.lit("immediate")).otherwise(F.lit("scheduled"))
    return decisions.where("retrain_needed").select(
        *carry,
        "priority",
        F.col("retrain_reasons").alias("reasons"),
        how.alias("action"),
        F.lit(requested_at).cast("timestamp").alias("requested_at"),
    )


def alert_record(statuses: DataFrame, carry: list[str] = (), levels=("alert", "critical")) -> DataFrame:
    """Rows to append to the alert table, with the retraining outcome when it is known."""
    known = [F.col("retrain_needed").alias("retraining_triggered")] if "retrain_needed" in statuses.columns else []
    return statuses.where(F.col("monitoring_status").isin(list(levels))).select(
        *carry,
        "monitoring_status",
        F.size("alerts").alias("alerts_count"),
        "alerts",
        F.upper("monitoring_status").alias("subject_status"),
        *known,
    )


def dashboard(results: DataFrame) -> DataFrame:
    """Add the four dashboard numbers; accuracy defaults to 0 here, unlike in the checks."""
    quality = _metric("passed_tests", 0) / F.greatest(_metric("total_tests", 1), F.lit(1.0))
    return results.withColumns(
        {
            "data_drift_share": _metric("drift_share", 0),
            "data_quality_score": quality,
            "model_accuracy": _metric("accuracy", 0),
            "bias_max_difference": F.coalesce(F.array_max(F.map_values("parity")), F.lit(0.0)),
        }
    )


def recommendations(board: DataFrame, thresholds: AdviceThresholds = AdviceThresholds()) -> DataFrame:
    """Add the recommendation texts to a dashboard frame."""
    texts = _messages(
        [
            (
                F.col("data_drift_share") > thresholds.drift,
                F.lit("Monitor data sources for distribution changes"),
            ),
            (
                F.col("model_accuracy") < thresholds.accuracy,
                F.lit("Consider model retraining or hyperparameter tuning"),
            ),
            (
                F.col("bias_max_difference") > thresholds.parity,
                F.lit("Review model for fairness across demographic groups"),
            ),
        ]
    )
    return board.withColumn("recommendations", texts)


def run_sections(sections: dict[str, Callable[[], object]]) -> tuple[dict[str, object], dict[str, str]]:
    """Run each section on its own, all side by side: (results, error text per failed section)."""
    spark = SparkSession.getActiveSession()
    done: dict[str, object] = {}
    errors: dict[str, str] = {}
    with ThreadPoolExecutor(max(1, len(sections))) as pool:
        # each thread gets its own copy of the caller's local properties
        started = {name: pool.submit(inheritable_thread_target(spark)(work) if spark else work) for name, work in sections.items()}
    for name, future in started.items():
        try:
            done[name] = future.result()
        except Exception as error:  # one broken section must not stop the others
            log.exception("section %s failed", name)
            errors[name] = f"{type(error).__name__}: {error}".splitlines()[0]
    return done, errors


def training_report(spark, trained_at, n_train: int, n_test: int, n_features: int, metrics: dict, ready: bool) -> DataFrame:
    """One nested row, ready for ``write_summary``."""
    row = [(as_datetime(trained_at), (n_train, n_test, n_features), {k: float(v) for k, v in metrics.items()}, ready)]
    return spark.createDataFrame(
        row,
        "training_timestamp timestamp, dataset_info struct<train_samples bigint, test_samples bigint, features int>, "
        "model_performance map<string,double>, deployment_ready boolean",
    )
