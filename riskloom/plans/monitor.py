"""Monitoring job: drift, quality, performance, fairness, then the roll-up."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import MonitorThresholds, RetrainThresholds, Roles, SuiteConfig
from riskloom.operators.drift import (
    choose_methods,
    column_drift,
    comparable,
    conflicts,
    correlations,
    drift_summary,
    missing_compare,
)
from riskloom.operators.fairness import fairness_rates, parity_of_rates
from riskloom.operators.metrics import performance_report
from riskloom.operators.quality import run_suite, suite_summary
from riskloom.operators.rollup import (
    alert_record,
    dashboard,
    monitor_status,
    recommendations,
    retrain_decision,
    retrain_request,
    run_sections,
)
from riskloom.plans.predict import score_table
from riskloom.session import as_datetime
from riskloom.sources.sinks import write_summary, write_table

RESULT_SCHEMA = (
    "run_id string, run_ts timestamp, n_rows bigint, n_columns int, drift_share double, failed_tests bigint, "
    "passed_tests bigint, total_tests bigint, accuracy double, f1 double, parity map<string,double>, "
    "errors map<string,string>"
)


@dataclass
class MonitorConfig:
    roles: Roles
    suite: SuiteConfig
    sensitive: dict[str, str | Column] = field(default_factory=dict)
    drift_methods: dict[str, str] | None = None
    thresholds: MonitorThresholds = field(default_factory=MonitorThresholds)
    retrain: RetrainThresholds = field(default_factory=RetrainThresholds)
    mode: str = "last_write"


@dataclass
class MonitorResult:
    results: DataFrame
    sections: dict[str, DataFrame]
    errors: dict[str, str]
    held: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        """Give back what the sections share in memory; call it when their frames are no longer read."""
        for frame in self.held:
            frame.unpersist()


def monitor(ref: DataFrame, cur: DataFrame, cfg: MonitorConfig, run_id: str, run_ts, scorer=None) -> MonitorResult:
    """One result row with status, alerts, retrain decision, dashboard numbers and advice.

    ``scorer`` is a ``(prep, model)`` pair, as the first two of ``load_scorer``: it scores a current table
    that carries no predictions yet. Sections fail on their own: a broken one becomes an error entry and its
    numbers take the documented defaults. Performance, conflicts and fairness run only when there
    are predictions. Every section's rows are in ``sections`` by name.
    """
    spark, roles = cur.sparkSession, cfg.roles
    compared = [*roles.numeric, *roles.categorical]
    frames: dict[str, DataFrame] = {}
    numbers: dict[str, object] = {}
    if scorer is not None and roles.prediction not in cur.columns:
        cur = score_table(cur, *scorer, roles.prediction, roles.score or "probability")
    cur = cur.persist()
    held = [cur]
    n_rows = cur.count()  # holds every row before the sections, which run side by side, ask for them

    def keep(name: str, frame: DataFrame) -> DataFrame:
        frames[name] = frame.persist()
        held.append(frames[name])
        return frames[name]

    def drift():
        methods = cfg.drift_methods or choose_methods(list(roles.numeric), list(roles.categorical))
        found = keep("drift", column_drift(ref, cur, methods))
        frames["missing"] = missing_compare(ref, cur, [c for c in compared if comparable(ref, cur, c)])
        numbers["drift_share"] = drift_summary(found).first()["drift_share"]

    def correlation():
        numeric = [c for c in roles.numeric if comparable(ref, cur, c)]
        sides = [correlations(df, numeric).withColumnRenamed("correlation", name) for df, name in ((ref, "ref"), (cur, "cur"))]
        both = sides[0].join(F.broadcast(sides[1]), ["a", "b"])  # one row per column pair
        frames["correlations"] = both.withColumn("change", F.col("cur") - F.col("ref"))

    def quality():
        results = keep("quality", run_suite(ref, cur, cfg.suite, compared, list(roles.numeric)))
        numbers.update(suite_summary(results).first().asDict())

    def model_performance():
        report = keep("performance", performance_report(cur, roles.target, roles.prediction, roles.score, ref))
        found = {r["name"]: r["value"] for r in report.where("section = 'quality'").collect()}  # five rows
        numbers["accuracy"], numbers["f1"] = found["accuracy"], found["f1_score"]

    def conflicting():
        parts = [
            conflicts(cur, list(compared), y).withColumn("conflict", F.lit(name))
            for name, y in (("target", roles.target), ("prediction", roles.prediction))
        ]
        frames["conflicts"] = parts[0].unionByName(parts[1])

    def bias():
        rates = keep("fairness", fairness_rates(cur, cfg.sensitive, roles.prediction, roles.target))
        found = parity_of_rates(rates).collect()  # one row per sensitive feature
        numbers["parity"] = {r["feature"]: r["parity_difference"] for r in found}

    sections = {"drift": drift, "correlations": correlation, "quality": quality}
    if roles.prediction in cur.columns:
        sections["performance"] = model_performance
        sections["conflicts"] = conflicting
        if cfg.sensitive:
            sections["fairness"] = bias
    _, errors = run_sections(sections)

    row = (
        run_id,
        as_datetime(run_ts),
        n_rows,
        len(cur.columns),
        *[numbers.get(k) for k in ("drift_share", "failed_tests", "passed_tests", "total_tests", "accuracy", "f1")],
        numbers.get("parity", {}),
        errors,
    )
    results = spark.createDataFrame([row], RESULT_SCHEMA)
    results = monitor_status(results, cfg.thresholds, cfg.mode)
    results = retrain_decision(results, cfg.retrain, cfg.mode)
    return MonitorResult(recommendations(dashboard(results)), frames, errors, held)


def save_monitoring(result: MonitorResult, root: str, run_ts) -> None:
    """Append results, every section's rows, alerts and retrain requests; refresh the dashboard document."""
    carry = ["run_id", "run_ts", "n_rows", "n_columns"]
    run = result.results.first()["run_id"]
    for name, frame in result.sections.items():
        stamped = frame.select(F.lit(run).alias("run_id"), F.lit(as_datetime(run_ts)).alias("run_ts"), "*")
        write_table(stamped, f"{root}/sections/{name}", mode="append")
    write_table(result.results, f"{root}/results", mode="append")
    write_table(alert_record(result.results, carry), f"{root}/alerts", mode="append")
    write_table(retrain_request(result.results, run_ts, carry), f"{root}/retrain_requests", mode="append")
    write_summary(result.results, f"{root}/dashboard")
