import datetime as dt

import pytest

from riskloom.operators import rollup as U

SCHEMA = (
    "drift_share double, failed_tests bigint, passed_tests bigint, total_tests bigint, accuracy double, f1 double, "
    "parity map<string,double>"
)
# drift, failed, accuracy, F1, parity -> status last/max, priority last/max
GRID = [
    ((0.40, 0, 0.80, 0.75, 0.05), "alert", "alert", "high", "high"),
    ((0.40, 2, 0.80, 0.75, 0.05), "warning", "alert", "high", "high"),
    ((0.10, 0, 0.70, 0.75, 0.20), "warning", "critical", "critical", "critical"),
    ((0.10, 0, 0.70, 0.60, 0.05), "critical", "critical", "high", "critical"),
    ((0.10, 3, 0.80, 0.75, 0.05), "warning", "warning", "medium", "medium"),
    ((0.10, 2, 0.80, 0.75, 0.05), "warning", "warning", "low", "low"),
    ((0.10, 0, 0.80, 0.75, 0.12), "warning", "warning", "low", "low"),
    ((0.10, 0, 0.80, 0.75, 0.05), "healthy", "healthy", "low", "low"),
]


def frame(spark, drift, failed, accuracy, f1, parity):
    gaps = None if parity is None else {"age": parity}
    return spark.createDataFrame([(drift, failed, 10, 14, accuracy, f1, gaps)], SCHEMA)


@pytest.mark.parametrize("case, last, severe, priority, severe_priority", GRID)
def test_status_and_priority_grid(spark, case, last, severe, priority, severe_priority):
    df = frame(spark, *case)
    assert U.monitor_status(df).first()["monitoring_status"] == last
    assert U.monitor_status(df, mode="max_severity").first()["monitoring_status"] == severe
    row = U.retrain_decision(df).first()
    assert row["priority"] == priority and row["retrain_needed"] == (priority != "low")
    assert U.retrain_decision(df, mode="max_severity").first()["priority"] == severe_priority


def test_messages_in_order(spark):
    df = frame(spark, 0.5, 3, 0.7, 0.6, 0.2)
    assert U.monitor_status(df).first()["alerts"] == [
        "Data drift detected",
        "Data quality tests failed: 3",
        "Model performance below threshold",
        "Bias detected in age",
    ]
    assert U.retrain_decision(df).first()["retrain_reasons"] == [
        "High data drift detected",
        "Model accuracy below threshold",
        "F1 score below threshold",
        "Bias detected in age",
        "Multiple data quality test failures",
    ]


def test_defaults_when_sections_are_absent(spark):
    df = frame(spark, None, None, None, None, None)
    row = U.monitor_status(df).first()
    assert (row["monitoring_status"], row["alerts"]) == ("healthy", [])
    assert U.retrain_decision(df).first()["retrain_needed"] is False
    board = U.recommendations(U.dashboard(df)).first()
    assert (board["data_drift_share"], board["model_accuracy"], board["bias_max_difference"]) == (0.0, 0.0, 0.0)
    assert board["recommendations"] == ["Consider model retraining or hyperparameter tuning"]


def test_dashboard_and_advice(spark):
    board = U.recommendations(U.dashboard(frame(spark, 0.21, 4, 0.9, 0.9, 0.11))).first()
    assert board["data_quality_score"] == pytest.approx(10 / 14)
    assert board["recommendations"] == [
        "Monitor data sources for distribution changes",
        "Review model for fairness across demographic groups",
    ]


def test_records(spark):
    bad = frame(spark, 0.1, 0, 0.7, 0.75, 0.05)
    alert = U.alert_record(U.monitor_status(U.retrain_decision(bad))).first()
    assert (alert["monitoring_status"], alert["alerts_count"], alert["subject_status"]) == ("critical", 1, "CRITICAL")
    assert alert["retraining_triggered"] is True
    request = U.retrain_request(U.retrain_decision(bad), "2024-01-01 00:00:00").first()
    assert (request["priority"], request["action"]) == ("critical", "immediate")
    fine = frame(spark, 0.1, 0, 0.9, 0.9, 0.05)
    assert U.alert_record(U.monitor_status(fine)).count() == 0
    assert U.retrain_request(U.retrain_decision(fine), "2024-01-01 00:00:00").count() == 0


def test_sections_are_isolated():
    def broken():
        raise ValueError("no such column")

    done, errors = U.run_sections({"a": lambda: 1, "b": broken, "c": lambda: 3})
    assert done == {"a": 1, "c": 3} and errors == {"b": "ValueError: no such column"}


def test_training_report(spark):
    row = U.training_report(spark, dt.datetime(2024, 1, 1), 80, 20, 8, {"accuracy": 0.9}, True).first()
    assert row["dataset_info"]["train_samples"] == 80 and row["model_performance"] == {"accuracy": 0.9}
