import json

import pytest
from pyspark.sql import functions as F

from riskloom.config import POSITIVE_CLASS
from riskloom.operators import joins as J
from riskloom.operators.profile import summary_measures
from riskloom.sources import sinks as K
from riskloom.sources import tables as S


def test_read_table_errors_and_fallback(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="gone"):
        S.read_table(spark, str(tmp_path / "gone"))
    with pytest.raises(ValueError, match="schema"):
        S.read_table(spark, str(tmp_path), fmt="csv")
    other = S.read_with_fallback(lambda: S.read_table(spark, str(tmp_path / "gone")), lambda: spark.range(3))
    assert other.count() == 3


def test_csv_round_trip_with_nan(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 0.5)], "i int, x double")
    path = K.write_table(df, str(tmp_path / "csv"), fmt="csv")
    back = {r["i"]: r["x"] for r in S.read_table(spark, path, "i int, x double", "csv").collect()}
    assert back == {1: None, 2: 0.5}
    stored = K.write_table(df, str(tmp_path / "pq"))
    plain = S.read_table(spark, stored, nan_as_null=False).where("x > 0.25")
    assert "GreaterThan(x,0.25)" in plain._jdf.queryExecution().executedPlan().toString()


def test_run_stamp_partition_and_summary(spark, tmp_path):
    stamp = K.run_stamp(F.lit("2024-01-02 03:04:05").cast("timestamp"))
    df = spark.range(3).withColumn("run_ts", stamp)
    K.write_table(df, str(tmp_path / "t"), partition_by=["run_ts"])
    assert (tmp_path / "t" / "run_ts=20240102_030405").is_dir()
    K.write_summary(df.agg(F.struct(F.count("*").alias("n")).alias("s")), str(tmp_path / "s"))
    assert spark.read.schema("s struct<n: bigint>").json(str(tmp_path / "s")).first()["s"]["n"] == 3


def test_load_labeled(spark):
    df = spark.createDataFrame(
        [(1, POSITIVE_CLASS), (2, "tested_negative"), (3, None)], "preg int, class string"
    )
    out = S.load_labeled(df, "class", POSITIVE_CLASS).orderBy("pregnancies")
    assert out.columns == ["pregnancies", "target"]
    assert [r["target"] for r in out.collect()] == [1, 0, 0]


def test_json_requests_to_rows(spark):
    patient = {"patient_id": "P1", "pregnancies": 2, "glucose": 120.0, "age": 35}
    body = json.dumps({"batch_id": "B1", "patients": [patient, {**patient, "patient_id": "P2"}], "metadata": {"a": "b"}})
    requests = S.parse_requests(spark.createDataFrame([(body,)], "body string"), "body")
    rows = S.explode_requests(requests).orderBy("patient_id").collect()
    assert [(r["batch_id"], r["patient_id"], r["glucose"], r["bmi"]) for r in rows] == [
        ("B1", "P1", 120.0, None),
        ("B1", "P2", 120.0, None),
    ]


def test_batch_response_rejects_oversize_batches(spark):
    """One batch holds most rows; it must come back as rejected with its size, not vanish."""
    rows = [("hot", i, 1, 0.9) for i in range(50)] + [("a", 1, 1, 0.8), ("a", 0, 0, 0.1), ("b", 5, 0, 0.2)]
    df = spark.createDataFrame(rows, "batch string, member int, prediction int, probability double")
    docs, oversize = K.to_batch_response(
        df, "batch", ["member"], ["prediction", "probability"], summary_measures("prediction", "probability"), limit=10
    )
    got = {r["batch"]: r for r in docs.collect()}
    assert set(got) == {"a", "b"}
    assert [p["member"] for p in got["a"]["predictions"]] == [0, 1]
    assert (got["a"]["summary"]["total"], got["a"]["summary"]["high_risk"]) == (2, 1)
    assert [(r["batch"], r["n_members"]) for r in oversize.collect()] == [("hot", 50)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    """A third of the rows share one key and are exact copies of each other."""
    big = spark.createDataFrame([(7, "copy")] * 100 + [(i, f"r{i}") for i in range(200)], "k int, v string").repartition(6)
    small = spark.createDataFrame([(i, i * 10) for i in range(0, 300, 7)], "k int, w int")
    plain = big.join(small, ["k"], how)
    salted = J.salted_join(big, small, ["k"], how, salts=5)
    assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    for limit in (10, 10_000):
        checked = J.join_small(big, small, ["k"], how, limit=limit)
        assert sorted(map(tuple, checked.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_salted_join_refuses_to_preserve_the_replicated_side(spark):
    with pytest.raises(ValueError):
        J.salted_join(spark.range(1), spark.range(1), ["id"], "right")


def test_attach_predictions_keeps_rows(spark):
    preds = spark.createDataFrame([(1, 1)], "id long, prediction int")
    for salts in (0, 4):
        out = J.attach_predictions(spark.range(3), preds, ["id"], salts).orderBy("id").collect()
        assert [r["prediction"] for r in out] == [None, 1, None]
