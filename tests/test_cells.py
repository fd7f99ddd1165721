"""Layouts and weighted cells: what a fit's passes cost must not grow with every row."""

import pytest
from pyspark.sql import functions as F

from bindings.answering import ROWS_PER_FILE, request_files
from riskloom.operators import calibration as C
from riskloom.operators import models as L


@pytest.mark.parametrize(("rows", "most"), [(0, 1), (12_500, 1), (480_000, 24), (28_800_000, 29), (172_800_000, 173)])
def test_layout_keeps_few_partitions_and_has_no_upper_end(rows, most):
    assert L.layout_partitions(rows) <= most
    assert rows <= max(1, L.layout_partitions(rows)) * L.ROWS_PER_PARTITION


def _rows(spark, copies):
    one = spark.range(600).select(
        (F.col("id") * 37 % 211).cast("double").alias("x"),
        (F.col("id") % 3).cast("double").alias("flag"),
        ((F.col("id") * 37 % 211 + F.col("id") % 7 * 9) > 130).cast("double").alias("y"),
    )
    return one.join(spark.range(copies).select(F.col("id").alias("copy")), how="cross")


def test_boosting_sees_cells_and_copies_change_nothing(spark, monkeypatch):
    seen, laid = [], L.stable_layout

    def counted(df, *args, **kwargs):
        seen.append(df.agg(F.count("*"), F.sum(L.WEIGHT)).first())
        return laid(df, *args, **kwargs)

    monkeypatch.setattr(L, "stable_layout", counted)
    scores = []
    for copies in (1, 20):
        df = _rows(spark, copies)
        model = L.train(df, "gradient_boosting", ["x", "flag"], "y", {"n_estimators": 3})
        scored = L.score(model, df.where("copy = 0")).orderBy("x", "flag", "y").collect()
        scores.append([round(r.probability, 9) for r in scored])
    assert scores[0] == scores[1]
    assert seen[0][0] == seen[1][0] <= 32 * 3 * 2 and [s[1] for s in seen] == [600, 12_000]


def test_bins_hold_every_value_if_few_else_quantiles(spark):
    df = _rows(spark, 2)
    x, flag = L.bin_edges(df, ["x", "flag"], 32)
    assert flag[1:-1] == [1.0, 2.0] and len(x) == 33
    (constant,) = L.bin_edges(df.withColumn("x", F.lit(4.0)), ["x"], 32)
    assert len(constant) == 3


@pytest.mark.parametrize("family", ["logistic_regression", "svm"])
def test_linear_fits_see_distinct_rows(spark, monkeypatch, family):
    df = _rows(spark, 5)
    seen, laid = [], L.stable_layout

    def counted(frame, *args, **kwargs):
        seen.append(frame.agg(F.count("*"), F.sum(L.WEIGHT)).first())
        return laid(frame, *args, **kwargs)

    monkeypatch.setattr(L, "stable_layout", counted)
    params = {"max_iter": 20, "c": 1.0, "tol": 1e-10}
    fitted = L.train(df, family, ["x", "flag"], "y", params).stages[1]
    assert seen[0][0] <= 600 and seen[0][1] == 3000
    rows = L.pipeline(family, ["x", "flag"], "y", {**params, "reg": 1 / 3000}).fit(df).stages[1]
    near = 0.05 if family == "svm" else 1e-6  # the hinge has edges, where the order of a sum decides a step
    assert list(fitted.coefficients) == pytest.approx(list(rows.coefficients), rel=near, abs=1e-9)


def test_held_out_folds_keep_every_row(spark):
    df = _rows(spark, 4)
    margins = C.held_out_margins(df, ["x", "flag"], "y", ["x", "flag", "copy"], params={"max_iter": 5})
    assert margins.count() == df.count()


def test_files_of_a_stream_stay_bounded_in_rows():
    assert request_files(60_000) == 4
    assert 216_000_000 / request_files(216_000_000) <= ROWS_PER_FILE
