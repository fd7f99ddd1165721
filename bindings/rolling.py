"""Roll-up rules over a table of daily monitoring runs derived from lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.base import CUR_SQL, FEATURES, REF_SQL, SCORED, lines, query, rounded, scored_lines, snapshots
from bindings.drifting import CATS, _js_sql, _psi_sql, _w_sql
from bindings.measuring import COUNTS_SQL, RATIOS_SQL
from riskloom.config import Roles, SuiteConfig
from riskloom.functions import cut_column
from riskloom.operators import rollup as U
from riskloom.operators.fairness import fairness_rates, parity_difference
from riskloom.operators.metrics import binary_metrics
from riskloom.plans.monitor import MonitorConfig, monitor

RANGES = {"l_extendedprice": (3000, 103000), "l_quantity": (1, 49), "l_discount": (0, 0.1), "l_tax": (0, 0.08)}
SHIFT = 0.35


def daily_runs(spark, sf) -> DataFrame:
    """One results row per ship day: drift share, range tests, accuracy, F1, parity."""
    df = lines(spark, sf).select(
        F.to_date("l_shipdate").cast("string").alias("run_id"),
        *FEATURES,
        "l_returnflag",
        "l_linestatus",
        (F.col("l_quantity") > 25).cast("int").alias("prediction"),
        (F.col("l_quantity") + F.lit(500) * (F.col("l_tax") - F.lit(0.04)) > 25).cast("int").alias("label"),
    )
    overall = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in FEATURES], *[F.stddev_samp(c).alias(f"s_{c}") for c in FEATURES]
        )
    ).scalar()
    failed = [
        ((F.min(c) < F.lit(lo)) | (F.max(c) > F.lit(hi))).cast("int") for c, (lo, hi) in RANGES.items()
    ]
    day = df.groupBy("run_id").agg(
        *[F.avg(c).alias(f"a_{c}") for c in FEATURES], sum(failed[1:], failed[0]).cast("bigint").alias("failed_tests")
    )
    stats = overall
    drifted = [
        (F.abs(F.col(f"a_{c}") - stats[f"m_{c}"]) > F.lit(SHIFT) * stats[f"s_{c}"]).cast("double") for c in FEATURES
    ]
    checks = day.select(
        "run_id",
        (sum(drifted[1:], drifted[0]) / F.lit(len(FEATURES))).alias("drift_share"),
        "failed_tests",
        (F.lit(len(RANGES)) - F.col("failed_tests")).alias("passed_tests"),
        F.lit(len(RANGES)).cast("bigint").alias("total_tests"),
    )
    quality = binary_metrics(df, "label", "prediction", ["run_id"]).select(
        "run_id", "accuracy", F.col("f1_score").alias("f1")
    )
    parity = None
    for group in ("l_returnflag", "l_linestatus"):
        gap = parity_difference(df, group, "prediction", ["run_id"]).withColumnRenamed("parity_difference", group)
        parity = gap if parity is None else parity.join(gap, "run_id")
    pairs = [x for g in ("l_returnflag", "l_linestatus") for x in (F.lit(g), F.col(g))]
    return checks.join(quality, "run_id").join(parity.select("run_id", F.create_map(*pairs).alias("parity")), "run_id")


def _gap(group: str) -> str:
    return f"""(select run_id, max(rate) - min(rate) as {group} from (
        select run_id, {group}, avg(prediction) as rate from days group by 1, 2) group by 1)"""


_FAILED = " + ".join(
    f"(min({c}) < {lo}::double or max({c}) > {hi}::double)::int" for c, (lo, hi) in RANGES.items()
)
_DRIFTED = " + ".join(f"(abs(a_{c} - m_{c}) > {SHIFT}::double * s_{c})::int" for c in FEATURES)
RUNS_SQL = f"""days as (select cast(cast(l_shipdate as date) as varchar) as run_id, *,
    case when l_quantity > 25 then 1 else 0 end as prediction,
    case when l_quantity + 500 * (l_tax - 0.04::double) > 25 then 1 else 0 end as label from lineitem),
  overall as (select {", ".join(f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}" for c in FEATURES)} from days),
  checks as (select run_id, {", ".join(f"avg({c}) as a_{c}" for c in FEATURES)}, {_FAILED} as failed_tests, {COUNTS_SQL}
             from days group by run_id),
  runs as (select run_id, ({_DRIFTED}) / 4 as drift_share, failed_tests, 4 - failed_tests as passed_tests, 4 as total_tests,
             accuracy, f1_score as f1, l_returnflag, l_linestatus
           from (select *, {RATIOS_SQL} from checks, overall)
           join {_gap("l_returnflag")} using (run_id) join {_gap("l_linestatus")} using (run_id))"""

_ALERTS = """concat_ws('|', case when drift_share > 0.25::double then 'Data drift detected' end,
    case when failed_tests > 0 then concat('Data quality tests failed: ', failed_tests) end,
    case when accuracy < 0.75::double then 'Model performance below threshold' end,
    case when l_linestatus > 0.1::double then 'Bias detected in l_linestatus' end,
    case when l_returnflag > 0.1::double then 'Bias detected in l_returnflag' end)"""
_STATUS = """case when l_linestatus > 0.1::double or l_returnflag > 0.1::double then 'warning'
    when accuracy < 0.75::double then 'critical' when failed_tests > 0 then 'warning'
    when drift_share > 0.25::double then 'alert' else 'healthy' end"""
_SEVERE = """case when accuracy < 0.75::double then 'critical' when drift_share > 0.25::double then 'alert'
    when failed_tests > 0 or l_linestatus > 0.1::double or l_returnflag > 0.1::double then 'warning' else 'healthy' end"""


@query(
    "monitor_status",
    f"with {RUNS_SQL} select run_id, {_STATUS} as last_write, {_SEVERE} as max_severity, {_ALERTS} as alerts from runs",
)
def _(spark, sf):
    runs = daily_runs(spark, sf)
    first = U.monitor_status(runs).withColumnRenamed("monitoring_status", "last_write").drop("alerts")
    both = U.monitor_status(first, mode="max_severity")
    return both.select(
        "run_id", "last_write", F.col("monitoring_status").alias("max_severity"), F.concat_ws("|", "alerts").alias("alerts")
    )


_RETRAIN_BIAS = "(l_linestatus > 0.15::double or l_returnflag > 0.15::double)"


@query(
    "retrain_decision",
    f"""with {RUNS_SQL}, d as (select run_id,
          case when f1 < 0.7::double then 'high' when accuracy < 0.75::double then 'critical'
               when drift_share > 0.3::double then 'high' when {_RETRAIN_BIAS} or failed_tests > 2 then 'medium' else 'low' end as priority,
          case when accuracy < 0.75::double then 'critical' when f1 < 0.7::double or drift_share > 0.3::double then 'high'
               when {_RETRAIN_BIAS} or failed_tests > 2 then 'medium' else 'low' end as severe_priority,
          concat_ws('|', case when drift_share > 0.3::double then 'High data drift detected' end,
            case when accuracy < 0.75::double then 'Model accuracy below threshold' end,
            case when f1 < 0.7::double then 'F1 score below threshold' end,
            case when l_linestatus > 0.15::double then 'Bias detected in l_linestatus' end,
            case when l_returnflag > 0.15::double then 'Bias detected in l_returnflag' end,
            case when failed_tests > 2 then 'Multiple data quality test failures' end) as reasons from runs)
        select *, reasons <> '' as retrain_needed from d""",
)
def _(spark, sf):
    runs = daily_runs(spark, sf)
    severe = U.retrain_decision(runs, mode="max_severity").withColumnRenamed("priority", "severe_priority")
    out = U.retrain_decision(severe.drop("retrain_needed", "retrain_reasons"))
    return out.select(
        "run_id", "priority", "severe_priority", F.concat_ws("|", "retrain_reasons").alias("reasons"), "retrain_needed"
    )


@query(
    "retrain_request",
    f"""with {RUNS_SQL}, d as (select run_id, case when f1 < 0.7::double then 'high' when accuracy < 0.75::double then 'critical'
               when drift_share > 0.3::double then 'high' else 'medium' end as priority,
             f1 < 0.7::double or accuracy < 0.75::double or drift_share > 0.3::double or {_RETRAIN_BIAS} or failed_tests > 2 as needed
           from runs)
        select run_id, priority, case when priority = 'critical' then 'immediate' else 'scheduled' end as action
        from d where needed""",
)
def _(spark, sf):
    out = U.retrain_request(U.retrain_decision(daily_runs(spark, sf)), "2001-12-01 00:00:00", ["run_id"])
    return out.select("run_id", "priority", "action")


@query(
    "alert_record",
    f"""with {RUNS_SQL}, s as (select run_id, {_SEVERE} as monitoring_status, {_ALERTS} as alerts from runs)
        select run_id, monitoring_status, cast(len(string_split(alerts, '|')) as integer) as alerts_count, alerts,
               upper(monitoring_status) as subject_status
        from s where monitoring_status in ('alert', 'critical')""",
)
def _(spark, sf):
    statuses = U.monitor_status(daily_runs(spark, sf), mode="max_severity")
    return U.alert_record(statuses, ["run_id"]).withColumn("alerts", F.concat_ws("|", "alerts"))


_BOARD = """drift_share as data_drift_share, passed_tests / total_tests as data_quality_score,
    accuracy as model_accuracy, greatest(l_returnflag, l_linestatus) as bias_max_difference"""


@query(
    "dashboard",
    f"""with {RUNS_SQL}, b as (select run_id, {_BOARD} from runs)
        select run_id, round(data_drift_share, 6) as data_drift_share, round(data_quality_score, 6) as data_quality_score,
               round(model_accuracy, 6) as model_accuracy, round(bias_max_difference, 6) as bias_max_difference from b""",
)
def _(spark, sf):
    names = ["data_drift_share", "data_quality_score", "model_accuracy", "bias_max_difference"]
    return rounded(U.dashboard(daily_runs(spark, sf)).select("run_id", *names))


@query(
    "recommendations",
    f"""with {RUNS_SQL}, b as (select run_id, {_BOARD} from runs)
        select run_id, concat_ws('|',
          case when data_drift_share > 0.2::double then 'Monitor data sources for distribution changes' end,
          case when model_accuracy < 0.8::double then 'Consider model retraining or hyperparameter tuning' end,
          case when bias_max_difference > 0.1::double then 'Review model for fairness across demographic groups' end)
          as recommendations from b""",
)
def _(spark, sf):
    out = U.recommendations(U.dashboard(daily_runs(spark, sf)))
    return out.select("run_id", F.concat_ws("|", "recommendations").alias("recommendations"))


ROLES = Roles(
    numeric=tuple(FEATURES),
    categorical=("l_returnflag", "l_linestatus"),
    target="label",
    prediction="prediction",
    score="probability",
)
SUITE = SuiteConfig(ranges=RANGES, means=("l_quantity", "l_discount"))


_ALL = [*FEATURES, *CATS]


def _side(name: str, test: str) -> str:
    return f"""{name} as (select {" + ".join(f"(count(*) filter ({c} is null) > 0)::int" for c in _ALL)} as columns_missing,
        count(*) filter ({" or ".join(f"{c} is null" for c in _ALL)}) as rows_missing,
        {" + ".join(f"coalesce(min({c}) = max({c}), true)::int" for c in _ALL)} as constant_columns,
        ({" + ".join(f"count(*) filter ({c} is null)" for c in _ALL)}) / (count(*) * {len(_ALL)}) as missing_share,
        (select coalesce(sum(n - 1), 0) from (select count(*) as n from lineitem where {test} group by {", ".join(_ALL)})) as copies,
        {", ".join(f"min({c}) as min_{c}, max({c}) as max_{c}, avg({c}) as avg_{c}, stddev_samp({c}) as std_{c}" for c in FEATURES)}
      from lineitem where {test})"""


_FAILED = " + ".join(
    [f"(c.{x} > r.{x})::int" for x in ("columns_missing", "rows_missing", "constant_columns", "copies", "missing_share")]
    + [f"(not (c.min_{x} >= {lo} and c.max_{x} <= {hi}))::int" for x, (lo, hi) in RANGES.items()]
    + [f"(abs(c.avg_{x} - r.avg_{x}) > 2 * r.std_{x})::int" for x in ("l_quantity", "l_discount")]
    + [f"((select count(*) from ({' union all '.join(_psi_sql(x) for x in FEATURES)}) where psi >= 0.2::double) > 0)::int"]
)
_MOVED = " union all ".join(
    [f"select wasserstein >= 0.1::double as moved from ({_w_sql(x)})" for x in FEATURES]
    + [f"select sqrt(greatest(js_divergence, 0) / ln(2)) >= 0.1::double from ({_js_sql(x)})" for x in CATS]
)


@query(
    "monitor",
    f"""with {SCORED}, {_side("r", REF_SQL)}, {_side("c", CUR_SQL)}, now as (
          select *, case when l_quantity > 0 and l_quantity <= 10 then 'tiny' when l_quantity > 10 and l_quantity <= 25 then 'small'
                         when l_quantity > 25 and l_quantity <= 40 then 'medium' when l_quantity > 40 and l_quantity <= 50 then 'large'
                    end as band from scored where {CUR_SQL}),
        q as (select n, {RATIOS_SQL} from (select count(*) as n, {COUNTS_SQL} from now)),
        p as (select (select max(a) - min(a) from (select avg(prediction) as a from now where band is not null group by band)) as band,
                     (select max(a) - min(a) from (select avg(prediction) as a from now group by l_returnflag)) as flag),
        f as (select {_FAILED} as failed from r, c), d as (select avg(moved::int) as share from ({_MOVED}))
        select 'lines' as run_id, n as n_rows, round(share, 6) as drift_share, failed::bigint as failed_tests, 13::bigint as total_tests,
               round(accuracy, 6) as accuracy, round(f1_score, 6) as f1,
               case when greatest(band, flag) > 0.1::double then 'warning' when accuracy < 0.75::double then 'critical'
                    when failed > 0 then 'warning' when share > 0.25::double then 'alert' else 'healthy' end as monitoring_status,
               concat_ws('|', case when share > 0.25::double then 'Data drift detected' end,
                         case when failed > 0 then 'Data quality tests failed: ' || failed end,
                         case when accuracy < 0.75::double then 'Model performance below threshold' end,
                         case when band > 0.1::double then 'Bias detected in quantity' end,
                         case when flag > 0.1::double then 'Bias detected in returnflag' end) as alerts,
               case when f1_score < 0.7::double then 'high' when accuracy < 0.75::double then 'critical'
                    when share > 0.3::double then 'high'
                    when greatest(band, flag) > 0.15::double or failed > 2 then 'medium' else 'low' end as priority,
               round((13 - failed) / 13, 6) as data_quality_score, round(greatest(band, flag), 6) as bias_max_difference,
               0::integer as n_errors
        from q, p, f, d""",
)
def _(spark, sf):
    """The whole monitoring job: current snapshot against the reference one."""
    ref, cur = snapshots(scored_lines(spark, sf))
    bands = cut_column("l_quantity", (0, 10, 25, 40, 50), ("tiny", "small", "medium", "large"))
    cfg = MonitorConfig(ROLES, SUITE, {"quantity": bands, "returnflag": "l_returnflag"})
    result = monitor(ref, cur, cfg, "lines", "2001-12-01 00:00:00").results
    return rounded(
        result.select(
            "run_id",
            "n_rows",
            "drift_share",
            "failed_tests",
            "total_tests",
            "accuracy",
            "f1",
            "monitoring_status",
            F.concat_ws("|", "alerts").alias("alerts"),
            "priority",
            "data_quality_score",
            "bias_max_difference",
            F.size("errors").alias("n_errors"),
        )
    )


@query(
    "group_performance",
    f"""with days as (select *, case when l_quantity > 25 then 1 else 0 end as prediction,
          case when l_quantity + 500 * (l_tax - 0.04::double) > 25 then 1 else 0 end as label from lineitem)
        select 'returnflag' as feature, l_returnflag as grp, count(*) as n, round(avg(prediction), 6) as rate,
               round(avg(label), 6) as label_mean from days group by l_returnflag""",
)
def _(spark, sf):
    df = lines(spark, sf).select(
        "l_returnflag",
        (F.col("l_quantity") > 25).cast("int").alias("prediction"),
        (F.col("l_quantity") + F.lit(500) * (F.col("l_tax") - F.lit(0.04)) > 25).cast("int").alias("label"),
    )
    return rounded(fairness_rates(df, {"returnflag": "l_returnflag"}, "prediction", "label"))
