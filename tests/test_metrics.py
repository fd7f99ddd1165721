import math
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift as D
from riskloom.operators import fairness as B
from riskloom.operators import metrics as M
from riskloom.operators import profile as A
from riskloom.operators.registry import latest_version


@pytest.fixture(scope="module")
def small(spark):
    rows = list(zip([1, 1, 0, 0, 1], [1, 0, 0, 1, 1], [0.9, 0.4, 0.4, 0.6, 0.8]))
    return spark.createDataFrame(rows, "y int, pred int, score double")


def test_hand_computed_metrics(small):
    row = M.performance(small, "y", "pred", "score").first()
    assert (row["tp"], row["fn"], row["fp"], row["tn"]) == (2, 1, 1, 1)
    assert row["accuracy"] == pytest.approx(0.6)
    for m in ("precision", "recall", "f1_score"):
        assert row[m] == pytest.approx(2 / 3)
    assert row["roc_auc"] == pytest.approx(0.75)


def test_single_class(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "y int, pred int, score double")
    row = M.performance(df, "y", "pred", "score").first()
    assert row["roc_auc"] is None and row["f1_score"] == 0.0 and row["accuracy"] == 1.0


def test_auc_brute_force_with_hot_score(spark):
    """Brute force over pairs; a third of the rows share one score; many buckets."""
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), 0.5 if i % 3 == 0 else round(rng.random(), 2)) for i in range(300)]
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    df = spark.createDataFrame(rows, "y int, s double")
    for size in (10, 75, 10_000):
        auc = M.roc_auc(df.repartition(3), "y", "s", rows_per_bucket=size).first()["roc_auc"]
        assert auc == pytest.approx(wins / (len(pos) * len(neg)))
    assert M.roc_auc(df, "y", "y").first()["roc_auc"] == 1.0


def test_by_class_and_confusion(small):
    rows = {r["class"]: r for r in M.by_class(small, "y", "pred").collect()}
    assert rows[1]["precision"] == pytest.approx(2 / 3) and rows[0]["recall"] == pytest.approx(0.5)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion(small, "y", "pred").collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 2}


def test_gate_lists_failures(spark):
    df = spark.createDataFrame(
        [(0.8, 0.7, 0.6, 0.7, None)], "accuracy double, precision double, recall double, f1_score double, roc_auc double"
    )
    row = M.gate(df).first()
    assert row["passed"] is False and row["failures"] == ["recall", "roc_auc"]


def test_pick_best_first_wins_and_none(spark):
    df = spark.createDataFrame([(0, "a", 0.5), (1, "b", 0.8), (2, "c", 0.8)], "position int, model string, f1_score double")
    assert M.pick_best(df).first()["model"] == "b"
    assert M.pick_best(df.withColumn("f1_score", F.lit(0.0))).first() is None


def test_latest_version_prefers_stage(spark):
    df = spark.createDataFrame(
        [("m", 1, "Production"), ("m", 3, "None"), ("m", 2, "Production"), ("n", 5, "None"), ("n", 9, "Archived")],
        "name string, version int, stage string",
    )
    assert {r["name"]: r["version"] for r in latest_version(df).collect()} == {"m": 2, "n": 5}


@pytest.fixture(scope="module")
def pair(spark):
    rng = random.Random(11)
    a = [(rng.gauss(0, 1), float(rng.randint(0, 4)), rng.choice("xyz")) for _ in range(400)]
    b = [(rng.gauss(0.4, 1.3), float(rng.randint(0, 5)), rng.choice("xyzz")) for _ in range(300)]
    schema = "g double, k double, c string"
    return spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), a, b


def _cdf_gap(a, b, at):
    return abs(sum(x <= at for x in a) / len(a) - sum(x <= at for x in b) / len(b))


@pytest.mark.parametrize("size", [50, 10_000])
def test_ks_and_wasserstein_brute_force(pair, size):
    ref, cur, a, b = pair
    got_ks = {r["feature"]: r["ks"] for r in D.ks(ref, cur, ["g", "k"], size).collect()}
    got_w = {r["feature"]: r["wasserstein"] for r in D.wasserstein(ref, cur, ["g", "k"], False, size).collect()}
    for i, c in enumerate(("g", "k")):
        xs, ys = [r[i] for r in a], [r[i] for r in b]
        points = sorted(set(xs + ys))
        gaps = [_cdf_gap(xs, ys, p) for p in points]
        assert got_ks[c] == pytest.approx(max(gaps))
        assert got_w[c] == pytest.approx(sum(g * (q - p) for g, p, q in zip(gaps, points, points[1:])))


def test_identical_snapshots_do_not_drift(pair):
    ref, _, _, _ = pair
    assert D.psi(ref, ref, ["g"]).first()["psi"] == 0
    row = D.ks(ref, ref, ["g"]).first()
    assert (row["ks"], row["p_value"]) == (0, 1.0)
    assert D.wasserstein(ref, ref, ["g"]).first()["wasserstein"] == 0
    assert D.js_divergence(ref, ref, ["c"]).first()["js_divergence"] == 0
    assert D.chi2(ref, ref, ["c"]).first()["p_value"] == 1.0
    out = D.dataset_drift(ref, ref, {"g": "psi", "k": "ks", "c": "chi2"}).first()
    assert (out["n_drifted"], out["drift_share"], out["dataset_drift"]) == (0, 0.0, False)


def test_p_values_against_published_points(spark):
    rows = [(3.841458820694124, 1), (5.991464547107979, 2), (7.814727903251179, 3), (18.307038053275146, 10)]
    df = spark.createDataFrame(rows, "x double, k int")
    for r in df.select(D._chi2_tail("x", "k").alias("p")).collect():
        assert r["p"] == pytest.approx(0.05, abs=1e-9)
    z = spark.createDataFrame([(1.959963984540054,)], "z double").select(D._normal_two_sided("z").alias("p"))
    assert z.first()["p"] == pytest.approx(0.05, abs=1e-9)


def test_proportion_test(spark):
    ref = spark.createDataFrame([(1,)] * 30 + [(0,)] * 70, "x int")
    cur = spark.createDataFrame([(1,)] * 50 + [(0,)] * 50, "x int")
    p = 80 / 200
    expected = 0.2 / math.sqrt(p * (1 - p) * (2 / 100))
    assert D.prop_z(ref, cur, {"x": F.col("x") == 1}).first()["z"] == pytest.approx(expected)
    assert D.z_test(ref, cur, ["x"]).first()["p_value"] < 0.05


def test_methods_do_not_follow_size():
    assert D.choose_methods(["g"], ["c"]) == {"g": "wasserstein", "c": "js"}


@pytest.mark.parametrize("method", ["psi", "ks", "wasserstein", "psi_cat", "js", "chi2", "z"])
def test_every_method_has_one_rule_for_empty_sides(spark, method):
    schema = "gone double, fresh double, nothing double, same double"
    ref = spark.createDataFrame([(float(i % 2), None, None, float(i % 2)) for i in range(50)], schema)
    cur = spark.createDataFrame([(None, float(i % 2), None, float(i % 2)) for i in range(50)], schema)
    nan = cur.withColumn("gone", F.lit(float("nan")))
    for now in (cur, nan) if method in ("psi", "ks", "wasserstein") else (cur,):
        out = D.column_drift(ref, now, {c: method for c in ("gone", "fresh", "nothing", "same", "absent")})
        got = {r["feature"]: (r["score"] is None, r["drifted"], r["status"]) for r in out.collect()}
        assert got == {
            "gone": (True, True, "no_current"),
            "fresh": (True, True, "no_reference"),
            "nothing": (True, False, "no_data"),
            "same": (False, False, "ok"),
            "absent": (True, True, "missing_column"),
        }


def test_scores_alone_are_null_without_values(spark):
    ref = spark.createDataFrame([(1.0, "a")] * 5, "x double, c string")
    none = ref.select(F.lit(None).cast("double").alias("x"), F.lit(None).cast("string").alias("c"))
    assert D.psi(ref, none, ["x"]).first()["psi"] is None
    assert tuple(D.ks(ref, none, ["x"]).first())[1:] == (None, None)
    assert D.wasserstein(ref, none, ["x"]).first()["wasserstein"] is None
    assert tuple(D.js_divergence(ref, none, ["c"]).first())[1:] == (None, None)
    assert D.chi2_stat(ref, none, ["c"]).first()["chi2"] is None
    assert D.prop_z(ref, none, {"x": F.col("x") == 1}).first()["z"] is None


def test_constant_reference_drifts(spark):
    ref = spark.createDataFrame([(5.0,)] * 20, "x double")
    assert D.psi(ref, ref.select((F.col("x") + 95).alias("x")), ["x"]).first()["psi"] > 10
    assert D.psi(ref, ref, ["x"]).first()["psi"] == 0


def test_same_shift_same_verdict_at_every_size(spark):
    for n in (1000, 1100):
        ref = spark.range(n).select((F.col("id") % 97).cast("double").alias("x"))
        cur = ref.select((F.col("x") + 4.5).alias("x"))
        row = D.column_drift(ref, cur, D.choose_methods(["x"])).first()
        assert (row["method"], row["drifted"]) == ("wasserstein", True)


def test_spearman_against_pandas(pair):
    ref, _, a, _ = pair
    pdf = ref.select("g", "k").toPandas()
    expected = pdf["g"].rank().corr(pdf["k"].rank())
    for size in (40, 10_000):
        row = D.correlations(ref, ["g", "k"], "spearman", size).first()
        assert row["correlation"] == pytest.approx(expected)


def test_conflicts(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (2, 0), (2, 0), (None, 0), (None, 1)], "f int, y int")
    row = D.conflicts(df, ["f"], "y").first()
    assert (row["n_groups"], row["n_rows"]) == (2, 5)


def test_groups_without_rows_or_label_are_ignored(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 0)], "g string, pred int")
    assert B.parity_difference(df, "g", "pred").first()[0] == pytest.approx(0.5)
    row = B.fairness(df, {"g": "g"}, "pred").first()
    assert (row["n_groups"], row["min_rate"], row["max_rate"]) == (2, 0.5, 1.0)


def test_profiles(spark):
    df = spark.createDataFrame([(1.0, "a"), (1.0, "a"), (3.0, "b"), (None, "a")], "x double, c string")
    assert A.duplicate_rows(df).first()[0] == 1
    assert A.duplicate_rows(df, ["c"]).first()[0] == A.duplicate_rows(df, ["c"], digest=["c"]).first()[0] == 2
    missing = {r["feature"]: (r["n_missing"], r["pct_missing"]) for r in A.missing_report(df).collect()}
    assert missing == {"x": (1, 25.0), "c": (0, 0.0)}
    counts = [(r["c"], r["n"], r["pct"]) for r in A.value_counts(df, "c").collect()]
    assert counts == [("a", 3, 75.0), ("b", 1, 25.0)]
    row = A.profile(df, ["x"]).first()
    assert (row["min"], row["max"], row["n_unique"]) == (1.0, 3.0, 2)
    assert A.imbalance(df, "c").first()[0] == pytest.approx(0.25)
    d = A.describe(df, ["x"]).first()
    assert (d["n"], d["min"], d["median"], d["max"]) == (3, 1.0, 1.0, 3.0)
    s = A.shape(df).first()
    assert (s["n_rows"], s["n_columns"]) == (4, 2)
    assert A.shape(df.where("x > 9")).first()["n_rows"] == 0
