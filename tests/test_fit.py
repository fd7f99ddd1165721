import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.config import CLINICAL
from riskloom.operators import ordered as O
from riskloom.operators.prep import NotFittedError, PrepModel, fit_impute, fit_scale, fit_statistics, prepare
from riskloom.operators.split import mark_test, stratified_split

TWO_ROWS = [
    ("A", 0, 50.0, 40.0, 0.0, 0.0, 15.0, 0.1, 21),
    ("B", 1, 200.0, 120.0, 50.0, 100.0, 50.0, 1.0, 80),
]
SCHEMA = (
    "patient_id string, pregnancies int, glucose double, blood_pressure double, skin_thickness double, "
    "insulin double, bmi double, diabetes_pedigree_function double, age int"
)


def test_two_row_edge_case(spark):
    df = spark.createDataFrame(TWO_ROWS, SCHEMA)
    model, out = PrepModel(CLINICAL).fit_transform(df)
    assert model.medians["skin_thickness"] == 50 and model.medians["insulin"] == 100
    a, b = out.orderBy("patient_id").collect()
    for c in ("pregnancies", "glucose", "blood_pressure", "bmi", "age", "bmi_age_interaction"):
        assert (a[c], b[c]) == (-1.0, 1.0), c
    for c in ("skin_thickness", "insulin", "high_pregnancy_risk"):
        assert (a[c], b[c]) == (0.0, 0.0), c
    assert not any(a[c] for c in CLINICAL.dummies)
    assert [c for c in CLINICAL.dummies if b[c]] == [
        "bmi_category_obese",
        "age_group_older",
        "glucose_category_diabetic",
    ]


def test_transform_properties(spark, patients, tmp_path):
    with pytest.raises(NotFittedError):
        PrepModel(CLINICAL).transform(patients)
    model, out = PrepModel(CLINICAL).fit_transform(patients)
    assert out.count() == patients.count()
    nulls = out.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in CLINICAL.output]).first()
    assert sum(nulls) == 0
    model.save(spark, str(tmp_path / "prep"))
    again = PrepModel.load(spark, str(tmp_path / "prep"))
    assert again == model
    one = again.transform(patients.limit(1))
    assert one.columns == out.columns and one.count() == 1


def test_wholly_missing_column_is_an_error(spark, patients):
    empty = patients.withColumn("insulin", F.lit(0.0))
    with pytest.raises(ValueError, match="insulin"):
        PrepModel(CLINICAL).fit(empty)
    with pytest.raises(ValueError, match="insulin"):
        fit_impute(empty.withColumn("insulin", F.lit(None).cast("double")), ["insulin"])


def test_fused_fit_equals_numpy(spark, patients):
    cols = ["glucose", "bmi", "insulin", "age", "pregnancies"]
    df = patients.select(*[F.nullif(F.col(c), F.lit(0)).alias(c) for c in cols])
    data = df.toPandas()
    medians, scaling = fit_statistics(df, cols, df.count())
    slow = fit_scale(df, fit_impute(df, cols))
    for c in cols:
        x = data[c].astype(float).to_numpy()
        m = np.nanmedian(x)
        q1, q2, q3 = np.percentile(np.where(np.isnan(x), m, x), [25, 50, 75])
        assert medians[c] == pytest.approx(m)
        assert scaling[c] == pytest.approx((q2, (q3 - q1) or 1.0))
        assert slow[c] == pytest.approx(scaling[c])


@pytest.mark.parametrize("missing", [0, 1, 3, 40])
def test_fused_fit_with_many_missing(spark, missing):
    values = [float((i * 7) % 11) for i in range(12)] + [None] * missing
    df = spark.createDataFrame([(v,) for v in values], "x double")
    medians, scaling = fit_statistics(df, ["x"], len(values))
    known = np.array([v for v in values if v is not None])
    filled = np.concatenate([known, np.full(missing, np.median(known))])
    q1, q2, q3 = np.percentile(filled, [25, 50, 75])
    assert medians["x"] == np.median(known)
    assert scaling["x"] == pytest.approx((q2, (q3 - q1) or 1.0))


def test_selection_equals_numpy_with_hot_value(spark, monkeypatch):
    """A third of all rows share one value; many buckets."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.lognormal(0, 3, 2000), np.full(1000, 1.25)])
    df = spark.createDataFrame([(float(v), float(-v)) for v in x], "x double, y double").repartition(5)
    monkeypatch.setattr(O, "ROWS_PER_BUCKET", 100)
    ps = [0.0, 0.1, 0.333, 0.5, 0.65, 0.999, 1.0]
    got = O.percentile_values(df, ["x", "y"], ps)
    assert got["x"] == pytest.approx(list(np.percentile(x, [p * 100 for p in ps])))
    assert got["y"] == pytest.approx(list(np.percentile(-x, [p * 100 for p in ps])))


def test_percentiles_of_empty_and_single(spark):
    df = spark.createDataFrame([(None,), (4.0,)], "x double")
    assert O.percentile_values(df, ["x"], [0.5])["x"] == [4.0]
    assert O.percentile_values(df.where("x > 9"), ["x"], [0.5])["x"] == [None]


def test_nan_is_no_value_at_any_size(spark, monkeypatch):
    df = spark.createDataFrame([(float(i),) for i in range(9)] + [(float("nan"),)] * 4, "x double")
    want = [4.0, 7.92]
    assert O.percentile_values(df, ["x"], [0.5, 0.99])["x"] == pytest.approx(want)
    monkeypatch.setattr(O, "ROWS_PER_BUCKET", 2)
    assert O.percentile_values(df, ["x"], [0.5, 0.99])["x"] == pytest.approx(want)
    assert O.percentile_values(df, ["x"], [0.5], approx=True)["x"] == [4.0]


def test_split_keys_with_nulls_differ(spark):
    rows = [("a", None, "b", 0), ("a", "b", None, 0), (None, "a", "b", 0), ("ab", None, None, 0), ("a;1:b", None, None, 0)]
    df = spark.createDataFrame(rows * 1, "p string, q string, r string, y int")
    assert mark_test(df, "y", 0.2, 1, ["p", "q", "r"]).where("is_test").count() == 1


@pytest.mark.parametrize("prefix", [None, 1, 3])
def test_split_is_exact_and_layout_free(spark, sf, prefix):
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price"]
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        *key[:-1], F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price"), "l_returnflag"
    )
    marked = mark_test(df, "l_returnflag", 0.2, 42, key, prefix)
    sizes = marked.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t"))
    for r in sizes.collect():
        assert r["t"] == -(-r["n"] // 5)
    again = mark_test(df.repartition(17), "l_returnflag", 0.2, 42, key, prefix)
    same = [m.where("is_test").agg(F.sum(F.xxhash64(*key).cast("decimal(38,0)"))).first()[0] for m in (marked, again)]
    assert same[0] == same[1]


def test_split_sides_and_seed(spark, patients):
    train, test = stratified_split(patients, "target", 0.25, 1, ["patient_id"])
    assert train.count() + test.count() == patients.count()
    assert train.join(test, "patient_id", "left_semi").count() == 0
    _, other = stratified_split(patients, "target", 0.25, 2, ["patient_id"])
    assert other.join(test, "patient_id", "left_anti").count() > 0


def test_split_rejects_a_key_that_is_not_unique(spark):
    df = spark.createDataFrame([(1, 0)] * 10, "k int, y int")
    with pytest.raises(Exception, match="not unique"):
        mark_test(df, "y", 0.25, 1, ["k"]).count()


def test_prepare_fits_on_train_only(spark, patients):
    train, test = stratified_split(patients, "target", 0.2, 42, ["patient_id"])
    model, train_out, test_out = prepare(train, test, CLINICAL)
    assert model.medians == PrepModel(CLINICAL).fit(train).medians
    assert train_out.columns == test_out.columns
