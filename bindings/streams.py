"""The monitoring jobs on the events stream; SQL twins are the batch results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.base import query, rounded, table, workspace
from riskloom.operators import models as L
from riskloom.streaming import operators as W
from riskloom.streaming.sinks import latest_windows, run_append, run_windows, stream_validate
from riskloom.streaming.source import read_stream

BOUNDS = {"value": (1, 150), "user_id": (0, 80)}


def with_scores(df: DataFrame) -> DataFrame:
    """Probability from the value; the label shifts it by the number inside ``props``."""
    shift = (F.get_json_object("props", "$.k").cast("double") - F.lit(50)) * F.lit(0.8)
    return df.withColumns(
        {
            "probability": F.col("value") / (F.col("value") + F.lit(50)),
            "prediction": (F.col("value") > 50).cast("int"),
            "label": (F.col("value") + shift > 50).cast("int"),
        }
    )


EVENTS_SQL = """scored as (select *, value / (value + 50) as probability,
    case when value > 50 then 1 else 0 end as prediction,
    case when value + (cast(json_extract_string(props, '$.k') as double) - 50) * 0.8::double > 50 then 1 else 0 end as label
  from events)"""


def events_stream(spark, sf) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return read_stream(spark, sf, schema, ts="ts", glob="events.parquet")


def finished(spark, windows: DataFrame, keys: list[str]) -> DataFrame:
    """Run a windowed stream over all available files and read its final windows."""
    root = workspace(spark, "streams")
    run_windows(windows, f"{root}/out", f"{root}/state")
    return latest_windows(spark, f"{root}/out", keys)


def as_text(df: DataFrame, col: str = "window_start") -> DataFrame:
    return df.withColumn(col, F.date_format(col, "yyyy-MM-dd HH:mm:ss"))


def _bucket(hours: int) -> str:
    return f"strftime(time_bucket(interval '{hours} hours', ts), '%Y-%m-%d %H:%M:%S') as window_start"


_BAD = "value < 1 or value > 150 or user_id < 0 or user_id > 80"


@query(
    "stream_quarantine",
    f"""select case when {_BAD} then 'rejected' else 'valid' end as part, count(*) as n,
          cast(sum(event_id) as bigint) as id_sum,
          count(*) filter (value < 1 or value > 150) as value_errors from events group by 1""",
)
def _(spark, sf):
    root = workspace(spark, "streams")
    stream_validate(events_stream(spark, sf), BOUNDS, f"{root}/good", f"{root}/bad", f"{root}/state")
    good = spark.read.parquet(f"{root}/good").select(
        F.lit("valid").alias("part"), "event_id", F.lit(None).cast("string").alias("errors")
    )
    bad = spark.read.parquet(f"{root}/bad").select(F.lit("rejected").alias("part"), "event_id", "errors")
    return (
        good.unionByName(bad)
        .groupBy("part")
        .agg(
            F.count("*").alias("n"),
            F.sum("event_id").alias("id_sum"),
            F.count_if(F.col("errors").contains("value must be between 1 and 150")).alias("value_errors"),
        )
    )


@query(
    "windowed_summary",
    f"""with {EVENTS_SQL} select {_bucket(6)}, count(*) as total, count(*) filter (prediction = 1) as predicted_positive,
          count(*) filter (prediction <> 1) as predicted_negative, count(*) filter (probability > 0.7::double) as high_risk,
          round(avg(probability), 6) as average_score from scored group by 1""",
)
def _(spark, sf):
    windows = W.windowed_summary(with_scores(events_stream(spark, sf)), "ts")
    return rounded(as_text(finished(spark, windows, ["window_start"])))


_PERF = f"""{EVENTS_SQL}, c as (select {_bucket(4)}, count(*) filter (label = 1 and prediction = 1) as tp,
    count(*) filter (label = 0 and prediction = 1) as fp, count(*) filter (label = 1 and prediction = 0) as fn,
    count(*) filter (label = 0 and prediction = 0) as tn from scored group by 1),
  m as (select *, (tp + tn) / (tp + fp + fn + tn) as accuracy, coalesce(tp / nullif(tp + fp, 0), 0) as precision,
    coalesce(tp / nullif(tp + fn, 0), 0) as recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1_score from c)"""


@query(
    "windowed_performance",
    f"""with {_PERF} select window_start, tp, fp, fn, tn, round(accuracy, 6) as accuracy, round(precision, 6) as precision,
          round(recall, 6) as recall, round(f1_score, 6) as f1_score from m""",
)
def _(spark, sf):
    windows = W.windowed_performance(with_scores(events_stream(spark, sf)), "ts", "label", "prediction")
    return rounded(as_text(finished(spark, windows, ["window_start"])))


_PSI_BINS = ", ".join(f"count(*) filter (bin = {b - 1}) as n{b}" for b in range(12))
_PSI_REF = ", ".join(f"count(*) filter (bin = {b - 1}) / count(*) as r{b}" for b in range(12))
_PSI_BIN = """case when value < lo then -1 when value > hi then 10
    else least(floor((value - lo) / ((hi - lo) / 10)), 9) end as bin"""
_PSI_TERMS = " + ".join(
    f"(greatest(n{b} / n, 0.0001::double) - greatest(r{b}, 0.0001::double)) * "
    f"ln(greatest(n{b} / n, 0.0001::double) / greatest(r{b}, 0.0001::double))"
    for b in range(12)
)


@query(
    "windowed_psi",
    f"""with edge as (select min(value) as lo, max(value) as hi from events where ts < timestamp '2024-01-15'),
        binned as (select *, {_PSI_BIN} from events, edge),
        ref as (select {_PSI_REF} from binned where ts < timestamp '2024-01-15'),
        w as (select {_bucket(4)}, event_type, count(*) as n, {_PSI_BINS} from binned group by 1, 2)
        select window_start, event_type, round({_PSI_TERMS}, 6) as psi_value from w, ref""",
)
def _(spark, sf):
    first_half = table(spark, sf, "events").where(F.col("ts") < F.expr("timestamp_ntz '2024-01-15'"))
    reference = W.reference_shares(first_half, ["value"])
    windows = W.windowed_psi(events_stream(spark, sf), "ts", reference, keys=["event_type"])
    return rounded(as_text(finished(spark, windows, ["window_start", "event_type"])))


@query(
    "windowed_alerts",
    f"""with {_PERF} select window_start, round(accuracy, 6) as accuracy, 'critical' as monitoring_status,
          'Model performance below threshold' as alerts from m where accuracy < 0.75::double""",
)
def _(spark, sf):
    windows = W.windowed_performance(with_scores(events_stream(spark, sf)), "ts", "label", "prediction")
    alerts = W.active_alerts(finished(spark, W.alert_stream(windows), ["window_start"]))
    return rounded(
        as_text(alerts).select("window_start", "accuracy", "monitoring_status", F.concat_ws("|", "alerts").alias("alerts"))
    )


@query(
    "windowed_drift_alerts",
    f"""with edge as (select min(value) as lo, max(value) as hi from events where ts < timestamp '2024-01-15'),
        binned as (select *, {_PSI_BIN} from events, edge),
        ref as (select {_PSI_REF} from binned where ts < timestamp '2024-01-15'),
        w as (select {_bucket(24)}, count(*) as n, {_PSI_BINS} from binned group by 1),
        p as (select window_start, {_PSI_TERMS} as psi from w, ref)
        select window_start, round(psi, 6) as psi_value, 'alert' as monitoring_status, 'Data drift detected' as alerts
        from p where psi >= 0.025::double""",
)
def _(spark, sf):
    first_half = table(spark, sf, "events").where(F.col("ts") < F.expr("timestamp_ntz '2024-01-15'"))
    reference = W.reference_shares(first_half, ["value"])
    windows = W.windowed_psi(events_stream(spark, sf), "ts", reference, width="24 hours")
    alerts = W.active_alerts(finished(spark, W.alert_stream(windows, psi_threshold=0.025), ["window_start"]))
    return rounded(as_text(alerts).withColumn("alerts", F.concat_ws("|", "alerts")))


@query("stream_score")
def _(spark, sf):
    """Fit on the stored events, score the stream into a table, summarise the table."""
    names = ["value", "user_id"]

    def ready(df):
        return with_scores(df).select("event_id", *[F.col(c).cast("double").alias(c) for c in names], "label")

    history = L.stable_layout(ready(table(spark, sf, "events")), ["event_id"])
    model = L.train(history, "logistic_regression", names, "label")
    root = workspace(spark, "streams")
    scored = L.score(model, ready(events_stream(spark, sf)), "predicted", "risk").select("event_id", "predicted", "risk")
    run_append(scored, f"{root}/scored", f"{root}/state")
    return rounded(
        spark.read.parquet(f"{root}/scored").groupBy("predicted").agg(F.count("*").alias("n"), F.avg("risk").alias("risk"))
    )
