import inspect
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.config import CLINICAL, CLINICAL_ROLES, CLINICAL_SUITE, RISK_LABELS, SuiteConfig
from riskloom.functions import cut_column
from riskloom.operators import models as L
from riskloom.operators.prep import PrepModel
from riskloom.operators.quality import run_suite, suite_summary
from riskloom.operators.registry import commit_file, committed_versions, load_champion, load_scorer, register, run_leaderboard
from riskloom.plans import MonitorConfig, monitor, predict, respond, score_table, train_job
from riskloom.plans.monitor import save_monitoring
from riskloom.plans.train import GateError

RUN_TS = "2024-01-02 03:04:05"
LIGHT = {
    "logistic_regression": {"max_iter": 50},
    "random_forest": {"n_estimators": 10, "max_depth": 5},
    "gradient_boosting": {"n_estimators": 5},
    "svm": {"max_iter": 30},
}


@pytest.fixture(scope="module")
def trained(spark, patients, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("train"))
    result = train_job(
        patients, CLINICAL, root, RUN_TS, params=LIGHT, trials=0, minimums={"accuracy": 0.5}, partitions=2
    )
    return root, result


def test_training_registers_a_champion(spark, trained):
    root, result = trained
    assert result.passed and result.version == 1
    rows = result.results.collect()
    assert {r["model"] for r in rows} == set(L.FAMILIES)
    for r in rows:
        assert all(0 <= r[m] <= 1 for m in ("accuracy", "precision", "recall", "f1_score", "roc_auc"))
    assert max(r["accuracy"] for r in rows) > 0.8
    assert result.champion.family in {r["model"] for r in rows}
    runs, metrics = (spark.read.parquet(f"{root}/{t}") for t in ("runs", "run_metrics"))
    board = run_leaderboard(runs, metrics, ["f1_score", "accuracy"]).collect()
    assert len(board) == 5 and board[0]["f1_score"] == max(r["f1_score"] for r in board)
    report = spark.read.json(f"{root}/reports").first()
    assert report["deployment_ready"] is True
    assert report["dataset_info"]["train_samples"] + report["dataset_info"]["test_samples"] == 400


def test_gate_blocks_registration(spark, patients, tmp_path):
    with pytest.raises(GateError, match="accuracy"):
        train_job(
            patients, CLINICAL, str(tmp_path), RUN_TS, families=("logistic_regression",), trials=0,
            minimums={"accuracy": 1.1}, partitions=2,
        )
    with pytest.raises(FileNotFoundError):
        load_champion(spark, str(tmp_path), "champion")


def test_prediction_job(spark, patients, trained, tmp_path):
    root, result = trained
    model, version = load_champion(spark, root, "champion")
    prep, _, same = load_scorer(spark, root, "champion")
    assert same == version and prep.medians == result.prep.medians and prep.feature_names == result.prep.feature_names
    assert version == "1"
    out = predict(patients, result.prep, model, str(tmp_path / "p"), RUN_TS, version)
    rows = out.predictions
    assert rows.count() == 400 and set(patients.columns) <= set(rows.columns)
    bounds = rows.agg(F.min("probability"), F.max("probability"), F.min("confidence_score")).first()
    assert 0 <= bounds[0] and bounds[1] <= 1 and bounds[2] >= 0.5
    summary = out.summary.first()
    assert summary["total"] == 400
    assert summary["predicted_positive"] + summary["predicted_negative"] == 400
    assert {r["feature"] for r in out.outliers.collect()} == {"glucose", "blood_pressure", "bmi", "age"}
    assert out.negatives.agg(F.sum("n_negative")).first()[0] == 0
    raw = rows.join(patients.select("patient_id", F.col("glucose").alias("g")), "patient_id")
    assert raw.where("glucose <> g").count() == 0
    fallback, name = load_champion(spark, str(tmp_path / "none"), "x", fallback=_model_path(spark, root))
    assert name == "fallback" and fallback.transform is not None


def _model_path(spark, root):
    return committed_versions(spark, root, "champion").first()["model_path"]


def test_parallel_writers_get_different_versions(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path)

    def write(k):
        return register(spark, root, "m", f"run{k}", f"/models/{k}", {"k": k}, RUN_TS)

    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(write, range(8)))
    assert sorted(numbers) == list(range(1, 9))
    rows = {r.version: r for r in committed_versions(spark, root, "m").collect()}
    assert {rows[v].run_id for v in numbers} == {f"run{k}" for k in range(8)}
    assert all(rows[v].tags == {"k": str(k)} and rows[v].run_id == f"run{k}" for k, v in enumerate(numbers))
    folder = tmp_path / "model_versions" / "m"
    (folder / "_left_over").write_text("{not a version")  # of a writer that died before its commit
    assert committed_versions(spark, root, "m").count() == 8
    assert not commit_file(spark, "other", str(folder / "0000000003.json"))
    assert committed_versions(spark, root, "m").where("version = 3").first() == rows[3]
    assert register(spark, root, "m", "run8", "/models/8", {}, RUN_TS) == 9
    assert committed_versions(spark, root, "other").count() == 0


def test_scoring_needs_all_columns(spark, patients, trained):
    _root, result = trained
    with pytest.raises(ValueError, match="insulin"):
        score_table(patients.drop("insulin"), result.prep, result.champion.model)


def test_same_seed_same_predictions_whatever_the_layout(spark, patients):
    prep = PrepModel(CLINICAL).fit(patients)
    names = CLINICAL.output

    def fit(df):
        ready = prep.transform(df).select(
            "patient_id", F.col("target").cast("double").alias("target"), *[F.col(c).cast("double").alias(c) for c in names]
        )
        model = L.train(L.stable_layout(ready, ["patient_id"], 3), "random_forest", names, "target", LIGHT["random_forest"])
        scored = L.score(model, ready).select("patient_id", "probability")
        return model, {r["patient_id"]: r["probability"] for r in scored.collect()}

    model, first = fit(patients)
    _, second = fit(patients.repartition(7))
    assert first == second
    weights = [r["importance"] for r in L.importances(model, names, spark).collect()]
    assert min(weights) >= 0 and sum(weights) == pytest.approx(1.0)


def test_search_spaces_and_search(spark, patients):
    assert L.draw_trials(L.SPACES["random_forest"], 5, 1) == L.draw_trials(L.SPACES["random_forest"], 5, 1)
    for family, space in L.SPACES.items():
        for trial in L.draw_trials(space, 50, 3):
            assert all(lo <= trial[k] <= hi for k, (lo, hi) in space.items())
    df = patients.select(F.col("glucose"), F.col("bmi"), F.col("target").cast("double").alias("target"))
    space = {"n_estimators": (2, 4), "learning_rate": (0.1, 0.3), "max_depth": (2, 3)}
    tuned = L.search(df, "gradient_boosting", ["glucose", "bmi"], "target", trials=2, space=space)
    assert set(tuned.params) == set(space) and 0 <= tuned.metrics["validation_f1"] <= 1
    assert L.search(df, "svm", ["glucose", "bmi"], "target") is None


def test_queries_do_not_lower_the_budgets(spark, sf, monkeypatch):
    from __spark_entry__ import queries

    called = {}

    class Enough(Exception):
        pass

    def stop(name):
        def made(*args, **kwargs):
            called[name] = inspect.signature(original[name]).bind(*args, **kwargs)
            called[name].apply_defaults()
            raise Enough

        return made

    original = {name: getattr(L, name) for name in ("search", "train")}
    for name in original:
        monkeypatch.setattr(L, name, stop(name))
    for query in ("hyperparameter_search", "importance_facts"):
        with pytest.raises(Enough):
            queries()[query](spark, sf)
    assert called["search"].arguments["trials"] == L.TRIALS == 50 and called["search"].arguments["space"] is None
    assert not called["train"].arguments["params"]



def scored(df):
    return df.withColumn("diabetes_prediction", (F.col("glucose") + 2 * F.col("bmi") > 220).cast("int"))


def test_monitoring_job(spark, patients, tmp_path):
    cfg = MonitorConfig(
        CLINICAL_ROLES, CLINICAL_SUITE, {"age": cut_column("age", (0, 30, 50, 100), ("young", "middle", "older"))}
    )
    same = monitor(patients, scored(patients), cfg, "r1", RUN_TS)
    row = same.results.first()
    assert same.errors == {} and row["drift_share"] == 0.0 and row["total_tests"] == 14
    assert row["accuracy"] > 0.8 and set(row["parity"]) == {"age"}
    moved = patients.withColumn("glucose", F.col("glucose") + 90).withColumn("bmi", F.col("bmi") * 3)
    row = monitor(patients, scored(moved), cfg, "r2", RUN_TS).results.first()
    assert row["drift_share"] == pytest.approx(2 / 8) and row["failed_tests"] > 0
    save_monitoring(same, str(tmp_path / "m"), RUN_TS)
    save_monitoring(same, str(tmp_path / "m"), RUN_TS)
    assert spark.read.parquet(str(tmp_path / "m" / "results")).count() == 2
    assert set(same.sections) == {"drift", "missing", "correlations", "quality", "performance", "conflicts", "fairness"}
    for name in same.sections:
        saved = spark.read.parquet(str(tmp_path / "m" / "sections" / name))
        assert saved.count() == 2 * same.sections[name].count() > 0
    assert same.sections["correlations"].where("abs(change) > 1e-9").count() == 0
    report = {(r["section"], r["name"]) for r in same.sections["performance"].collect()}
    assert {s for s, _ in report} == {"quality", "confusion", "by_class", "class_balance"}
    same.release()
    assert spark.read.json(str(tmp_path / "m" / "dashboard")).first()["run_id"] == "r1"


def test_requests_get_responses(spark, patients, trained):
    root, _ = trained
    prep, model, version = load_scorer(spark, root, "champion")
    member = F.struct(*[F.col(c) for c in patients.columns if c != "target"]).alias("m")
    whole = patients.where("glucose between 1 and 300 and bmi between 10 and 80 and insulin >= 0").select("patient_id", member)
    rows = [r.m for r in whole.orderBy("patient_id").limit(6).collect()]
    kind = T.StructType([T.StructField("batch_id", T.StringType()), T.StructField("patients", T.ArrayType(whole.schema["m"].dataType))])
    bad = rows[2].asDict() | {"glucose": 400.0}
    requests = spark.createDataFrame(
        [("good", rows[:2]), ("bad", [rows[0], bad]), ("large", rows[:5]), ("none", []), ("null", None)], kind
    )
    responses, errors = respond(requests, prep, model, {"glucose": (50, 300)}, RUN_TS, version, limit=4)
    got = {r.batch_id: r for r in responses.collect()}
    assert {k: (r.status, r.n_members, r.n_invalid) for k, r in got.items()} == {
        "good": ("accepted", 2, 0), "bad": ("rejected", 2, 1), "large": ("rejected", 5, 0),
        "none": ("rejected", 0, 0), "null": ("rejected", 0, 0),
    }
    good = got["good"]
    assert [p.patient_id for p in good.predictions] == [r.patient_id for r in rows[:2]]
    assert all(p.risk_category in RISK_LABELS for p in good.predictions)
    assert good.summary.total == 2 and good.model_version == version and good.processing_timestamp is not None
    assert all(r.predictions is None for k, r in got.items() if k != "good")
    assert [(r.batch_id, r.position) for r in errors.collect()] == [("bad", 2)]
    assert errors.first().message.startswith("Patient 2: glucose must be between 50 and 300")


def test_monitoring_scores_with_the_champion(spark, patients, trained):
    root, _ = trained
    prep, model, _ = load_scorer(spark, root, "champion")
    out = monitor(patients, patients, MonitorConfig(CLINICAL_ROLES, CLINICAL_SUITE), "r", RUN_TS, (prep, model))
    assert out.errors == {} and out.results.first()["accuracy"] > 0.7
    out.release()


def test_monitoring_of_a_table_that_lost_its_values(spark, patients):
    """Vanished columns are drift, not an error."""
    names = [*CLINICAL_ROLES.numeric]
    gone = patients.withColumns({c: F.lit(None).cast("double") for c in names})
    out = monitor(patients, gone, MonitorConfig(CLINICAL_ROLES, CLINICAL_SUITE), "r", RUN_TS)
    row = out.results.first()
    assert out.errors == {} and row["drift_share"] == 1.0 and "Data drift detected" in row["alerts"]


def test_forest_is_the_same_for_two_layouts_of_a_large_table(spark):
    """600,000 rows: far more than any sample of split points or boundaries."""
    df = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) > 40000).cast("double").alias("y"),
    )
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    forests = []
    for layout in (df, df.repartition(5)):
        ready = L.stable_layout(layout, key, 12)
        model = L.train(ready, "random_forest", ["l_quantity", "l_extendedprice"], "y", {"n_estimators": 3, "max_depth": 4})
        forests.append(model.stages[-1].toDebugString.split("\n", 1)[1])
    assert forests[0] == forests[1]


def test_monitoring_survives_a_broken_section(spark, patients):
    cfg = MonitorConfig(CLINICAL_ROLES, CLINICAL_SUITE, {"gone": "no_such_column"})
    out = monitor(patients, scored(patients), cfg, "r", RUN_TS)
    assert set(out.errors) == {"fairness"}
    row = out.results.first()
    assert row["accuracy"] is not None and row["parity"] == {} and "fairness" in row["errors"]


def test_monitoring_without_predictions(spark, patients):
    out = monitor(patients, patients, MonitorConfig(CLINICAL_ROLES, CLINICAL_SUITE), "r", RUN_TS)
    assert out.results.first()["accuracy"] is None and "performance" not in out.sections


def test_quality_suite(spark):
    ref = spark.createDataFrame([(float(i % 10), "a" if i % 2 else "b") for i in range(100)], "x double, c string")
    cur = ref.withColumn("x", F.when(F.col("x") == 9, None).otherwise(F.col("x") * 2)).withColumn("c", F.lit("a"))
    suite = SuiteConfig(ranges={"x": (0, 10), "absent": (0, 1)}, means=("x",))
    rows = {(r["test"], r["feature"]): r for r in run_suite(ref, cur, suite, ["x", "c"], ["x"]).collect()}
    status = {k: r["status"] for k, r in rows.items()}
    assert status[("columns_with_missing", "")] == "FAIL"
    assert status[("rows_with_missing", "")] == "FAIL" and rows[("rows_with_missing", "")]["value"] == 10
    assert status[("constant_columns", "")] == "FAIL"
    assert status[("column_types", "")] == "SUCCESS"
    assert status[("value_range", "x")] == "FAIL" and rows[("value_range", "x")]["value"] == 16
    assert status[("value_range", "absent")] == "ERROR"
    assert status[("mean_in_sigmas", "x")] == "SUCCESS"
    assert status[("drifted_columns", "")] == "FAIL"
    totals = suite_summary(run_suite(ref, ref, suite, ["x", "c"], ["x"])).first()
    assert (totals["total_tests"], totals["failed_tests"]) == (10, 1)
