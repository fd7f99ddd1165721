import pytest
from pyspark.sql import functions as F

from bindings.streams import with_scores
from riskloom.operators.drift import psi
from riskloom.session import shared_dir
from riskloom.streaming import operators as W
from riskloom.streaming.sinks import latest_windows, run_windows, stream_validate
from riskloom.streaming.source import event_time, read_stream

SCHEMA = "ts timestamp, user string, value double, label int, prediction int"


def feed(spark, path, rows):
    spark.createDataFrame(rows, "ts string, user string, value double, label int, prediction int").select(
        F.col("ts").cast("timestamp"), "user", "value", "label", "prediction"
    ).coalesce(1).write.mode("append").parquet(path)


def events(spark, sf):
    return event_time(spark.read.parquet(f"{sf}/events.parquet"), "ts")


@pytest.mark.parametrize("files", [None, 1])
def test_stream_equals_batch(spark, sf, tmp_path, files):
    """Summary, performance and PSI windows: streamed in several micro-batches and computed at once."""
    stored = with_scores(events(spark, sf)).select("ts", "event_type", "value", "probability", "prediction", "label")
    source = str(tmp_path / "in")
    stored.orderBy("ts").coalesce(1).write.option("maxRecordsPerFile", 400).parquet(source)
    reference = W.reference_shares(stored, ["value"])

    def jobs(df):
        return {
            "summary": (W.windowed_summary(df, "ts"), ["window_start"]),
            "performance": (W.windowed_performance(df, "ts", "label", "prediction"), ["window_start"]),
            "psi": (W.windowed_psi(df, "ts", reference, keys=["event_type"]), ["window_start", "event_type"]),
        }

    batch = jobs(stored)
    live = jobs(read_stream(spark, source, stored.schema, files_per_trigger=files))
    for name, (windows, keys) in live.items():
        out, state = str(tmp_path / name), str(tmp_path / f"{name}_state")
        run_windows(windows, out, state)
        got = latest_windows(spark, out, keys)
        want = batch[name][0]
        assert got.count() == want.count()
        rows = [[tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.orderBy(keys).collect()] for d in (got, want)]
        assert rows[0] == rows[1]


def test_window_psi_equals_table_psi(spark, sf):
    df = events(spark, sf)
    reference = W.reference_shares(df, ["value"])
    half = df.where(F.col("ts") < "2024-01-02")
    one = W.windowed_psi(half, "ts", reference, width="30 days").agg(F.count("*"), F.max("psi_value")).first()
    assert one[1] == pytest.approx(psi(df, half, ["value"]).first()["psi"])


def test_late_rows_are_dropped_and_restart_continues(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        df = read_stream(spark, source, SCHEMA, ts="ts")
        run_windows(W.windowed_performance(df, "ts", "label", "prediction", "4 hours", "1 hour"), out, state)
        return {str(r["window_start"]): r["tp"] for r in latest_windows(spark, out, ["window_start"]).collect()}

    feed(spark, source, [("2024-01-01 01:00:00", "a", 1.0, 1, 1), ("2024-01-01 23:00:00", "a", 1.0, 1, 1)])
    assert run() == {"2024-01-01 00:00:00": 1, "2024-01-01 20:00:00": 1}
    feed(spark, source, [("2024-01-01 02:00:00", "late", 1.0, 1, 1), ("2024-01-01 22:30:00", "b", 1.0, 1, 1)])
    assert run() == {"2024-01-01 00:00:00": 1, "2024-01-01 20:00:00": 2}
    assert run() == {"2024-01-01 00:00:00": 1, "2024-01-01 20:00:00": 2}


def test_stream_quarantine_splits_all_rows(spark, tmp_path):
    source = str(tmp_path / "in")
    feed(spark, source, [("2024-01-01 01:00:00", "a", v, 1, 1) for v in (1.0, 500.0, None)])
    stream_validate(
        read_stream(spark, source, SCHEMA), {"value": (0, 100)},
        str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "state"),
    )
    assert spark.read.parquet(str(tmp_path / "good")).count() == 1
    assert spark.read.parquet(str(tmp_path / "bad")).select("errors").distinct().first()[0] == "value must be between 0 and 100"


def test_alerts_are_a_projection(spark):
    df = spark.createDataFrame([(0.9,), (0.74,)], "accuracy double")
    rows = W.active_alerts(W.alert_stream(df)).collect()
    assert [(r["accuracy"], r["monitoring_status"]) for r in rows] == [(0.74, "critical")]
    both = spark.createDataFrame([(0.9, 0.1), (0.91, 0.3), (0.5, 0.3)], "accuracy double, psi_x double")
    rows = W.alert_stream(both).orderBy("accuracy").collect()
    assert [(r["monitoring_status"], len(r["alerts"])) for r in rows] == [("critical", 2), ("healthy", 0), ("alert", 1)]


def test_alerts_retract_when_a_window_recovers(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def run(rows):
        feed(spark, source, rows)
        frame = read_stream(spark, source, SCHEMA)
        windows = W.windowed_performance(frame, "ts", "label", "prediction", watermark="10 days")
        run_windows(W.alert_stream(windows), out, state)
        return W.active_alerts(latest_windows(spark, out, ["window_start"])).count()

    wrong = [("2024-01-01 01:00:00", "a", 1.0, 0, 1)]
    right = [("2024-01-01 01:30:00", "a", 1.0, 1, 1)] * 19
    assert run(wrong) == 1
    assert run(right) == 0


class FakeSession:
    """Just the settings that decide where shared files go."""

    def __init__(self, master, folder):
        self.master, self.applicationId = master, f"app-{master}"
        self.sparkContext = self
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}

    def getConf(self):
        return self.conf


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(FakeSession("spark://host", "/shared/folder"), "a") == "/shared/folder/a"
    assert shared_dir(FakeSession("local[2]", "/shared/folder")) == "/shared/folder"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("spark://host", None))
    assert shared_dir(spark) == shared_dir(spark)
