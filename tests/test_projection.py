import math

import pytest
from pyspark.sql import functions as F

from riskloom.config import CLINICAL, RISK_ADVICE, SCORING_BOUNDS
from riskloom.operators import projection as P
from riskloom.operators import validation as V
from riskloom.operators.profile import prediction_summary


def values(df, col):
    return [r[col] for r in df.collect()]


EDGES, NAMES = (0, 18.5, 25, 30, 100), ("a", "b", "c", "d")
POINTS = [-1.0, 0.0, 18.5, 18.6, 25.0, 30.0, 100.0, 101.0, None]


@pytest.mark.parametrize(
    "lowest, expected",
    [
        (True, [None, "a", "a", "b", "b", "c", "d", None, None]),
        (False, [None, None, "a", "b", "b", "c", "d", None, None]),
    ],
)
def test_right_closed_cut(spark, lowest, expected):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(POINTS)], "i int, x double")
    out = P.cut(df, "x", EDGES, NAMES, "band", include_lowest=lowest).orderBy("i")
    assert values(out, "band") == expected


def test_both_risk_rules(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.7,), (1.0,)], "p double")
    out = P.risk_category(df, "p", closed="right", out="table_rule")
    out = P.risk_category(out, "p", out="request_rule", advice=RISK_ADVICE).orderBy("p")
    assert values(out, "table_rule") == [None, "Low Risk", "Medium Risk", "High Risk"]
    assert values(out, "request_rule") == ["Low Risk", "Medium Risk", "High Risk", "High Risk"]
    assert values(out, "recommendation")[-1] == RISK_ADVICE["High Risk"]


def test_two_high_risk_counts(spark):
    df = spark.createDataFrame([(1, 0.7), (1, 0.9), (0, 0.1)], "prediction int, probability double")
    assert prediction_summary(df).first()["high_risk"] == 1
    row = prediction_summary(df, inclusive=True).first()
    assert (row["high_risk"], row["total"], row["predicted_positive"], row["predicted_negative"]) == (2, 3, 2, 1)


def test_flag_on_missing_is_zero(spark):
    df = spark.createDataFrame([(None,), (5,), (6,)], "x int")
    assert values(P.flag_gt(df, "x", 5, "f"), "f") == [0, 0, 1]


def test_zero_is_missing_only_in_listed_columns(patients):
    out = P.zero_to_null(patients, list(CLINICAL.zero_missing))
    counts = out.agg(F.count_if(F.col("glucose").isNull()), F.count_if(F.col("pregnancies").isNull())).first()
    assert counts[0] > 0 and counts[1] == 0


def test_engineer_columns_and_order(patients):
    out = P.engineer(patients, CLINICAL)
    assert [c for c in out.columns if c not in ("patient_id", "target")] == CLINICAL.output
    assert len(CLINICAL.output) == 18 and len(CLINICAL.numeric) == 11
    types = dict(out.dtypes)
    assert types["bmi_category_obese"] == "boolean" and types["high_pregnancy_risk"] == "int"
    assert P.numeric_features(out, ["target"]) == CLINICAL.numeric


def test_missing_category_equals_base_level_unless_flagged(spark):
    df = spark.createDataFrame([(250.0,), (90.0,)], "glucose double")
    cut = P.cut(df, "glucose", (0, 100, 125, 200), ("normal", "pre", "high"), "g", include_lowest=True)
    plain = P.dummies(cut, {"g": ["normal", "pre", "high"]}).collect()
    assert [(r["g_pre"], r["g_high"]) for r in plain] == [(False, False), (False, False)]
    flagged = P.dummies(cut, {"g": ["normal", "pre", "high"]}, unknown=True).collect()
    assert [r["g_unknown"] for r in flagged] == [True, False]


def test_aliases_and_rename(spark):
    df = spark.createDataFrame([(30.0, 1)], "mass double, plas int")
    assert P.resolve(df, CLINICAL.aliases).columns == ["bmi", "glucose"]
    assert P.rename(df, {"mass": "bmi", "absent": "x"}).columns == ["bmi", "plas"]


def test_align_and_dedup(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert P.align(df, ["c", "new", "a"]).first().asDict() == {"c": 3, "new": 0, "a": 1}
    twice = df.select("a", "b", F.col("c").alias("a"))
    out = P.dedup_columns(twice)
    assert out.columns == ["a", "b"] and out.first().asDict() == {"a": 1, "b": 2}


def test_clip_and_nan(spark):
    df = spark.createDataFrame([(-5.0,), (300.0,), (math.nan,), (None,)], "x double")
    out = values(P.clip(P.nulls_for_nan(df), {"x": (0, 200), "absent": (0, 1)}), "x")
    assert out == [0.0, 200.0, None, None]


def test_percentile_label_is_strict(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("s"))
    out = P.percentile_label(df, "s", 0.65, "y")
    assert out.agg(F.sum("y")).first()[0] == 35


def test_stamp_is_replayable(spark):
    row = P.stamp(spark.range(1), "2024-01-02 03:04:05", "7").first()
    assert str(row["prediction_timestamp"]) == "2024-01-02 03:04:05" and row["model_version"] == "7"


INVALID = ("p", -1.0, 400.0, 30.0, 25.0, 100.0, 5.0, 0.5, 15.0)
FIELDS = "patient_id string, " + ", ".join(f"{c} double" for c in SCORING_BOUNDS)


def test_row_errors_text_and_null_policy(spark):
    valid = ("q", 2.0, 120.0, 80.0, 25.0, 100.0, 28.5, 0.5, 35.0)
    holes = ("r", None, 120.0, 80.0, 25.0, 100.0, 28.5, 0.5, 35.0)
    df = spark.createDataFrame([INVALID, valid, holes], FIELDS)
    errors = values(V.row_errors(df, SCORING_BOUNDS).orderBy("patient_id"), "errors")
    assert errors[0] == (
        "pregnancies must be between 0 and 20; glucose must be between 50 and 300; "
        "blood_pressure must be between 40 and 200; bmi must be between 10 and 80; age must be between 18 and 120"
    )
    assert errors[1] is None
    assert errors[2] == "pregnancies must be between 0 and 20"
    assert values(V.row_errors(df, SCORING_BOUNDS, "pass").orderBy("patient_id"), "errors")[2] is None
    good, bad = V.quarantine(df, SCORING_BOUNDS)
    assert (good.count(), bad.count()) == (1, 2)


def test_required_columns(spark):
    with pytest.raises(V.MissingColumnsError, match="insulin"):
        V.require_columns(spark.range(1), ["id", "insulin"])


def test_batch_rules(spark):
    df = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 2, 50.0), ("b", 1, 5.0), ("c", 1, 5.0), ("c", 2, 5.0), ("c", 3, 5.0)],
        "batch string, member int, x double",
    )
    verdict = {r["batch"]: r["accepted"] for r in V.batch_verdict(df, "batch", {"x": (0, 10)}, limit=2).collect()}
    assert verdict == {"a": False, "b": True, "c": False}
    errors = V.batch_errors(df, "batch", ["member"], {"x": (0, 10)}).collect()
    assert [(r["batch"], r["member"], r["errors"]) for r in errors] == [("a", 2, "x must be between 0 and 10")]


def test_counts_and_flags(spark):
    df = spark.createDataFrame([(-1.0,), (5.0,), (None,)], "x double")
    assert V.negatives(df, ["x"]).first()["n_negative"] == 1
    assert V.outliers(df, {"x": (0, 4)}).first()["n_outliers"] == 2
    conf = P.confidence(df.select(F.lit(0.3).alias("probability")))
    assert V.low_confidence(conf).first()["low_confidence"] is True
    assert values(V.in_domain(df, "x", [5.0]), "in_domain") == [False, True, False]
