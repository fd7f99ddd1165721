"""Pipeline stage, models as relations, certificates of a fit, calibration."""

import duckdb
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.config import CLINICAL
from riskloom.operators import calibration as C
from riskloom.operators import models as L
from riskloom.operators import relations as R
from riskloom.operators.models import VECTOR
from riskloom.operators.prep import NotFittedError, PrepModel
from riskloom.operators.stage import PrepStage, PrepStageModel, scoring_pipeline, stage_of

SMALL = {
    "logistic_regression": {"tol": 1e-12, "c": 1.0},
    "random_forest": {"n_estimators": 7, "max_depth": 4},
    "gradient_boosting": {"n_estimators": 6, "max_depth": 3},
    "svm": {},
}
NAMES = CLINICAL.output


@pytest.fixture(scope="module")
def ready(patients):
    prep = PrepModel(CLINICAL).fit(patients)
    columns = [F.col(c).cast("double").alias(c) for c in NAMES]
    return prep.transform(patients).select("patient_id", F.col("target").cast("double").alias("target"), *columns).persist()


@pytest.fixture(scope="module")
def fitted(ready):
    return {f: L.train(ready, f, NAMES, "target", p) for f, p in SMALL.items()}


# --- one object from raw rows to probabilities ------------------------------------


@pytest.mark.parametrize("family", L.FAMILIES)
def test_saved_pipeline_scores_raw_rows(patients, tmp_path, family):
    raw = patients.withColumn("target", F.col("target").cast("double"))
    model = scoring_pipeline(CLINICAL, family, SMALL[family], raw.count()).fit(raw)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(again.stages[0], PrepStageModel) and again.stages[0].prep == model.stages[0].prep

    def scores(m, df):
        out = m.transform(df)
        assert out.columns[: len(df.columns)] == df.columns
        return out.select("patient_id", "glucose", "prediction", vector_to_array("probability")[1].alias("p")).orderBy("patient_id").collect()

    assert scores(again, raw) == scores(model, raw)
    prep = PrepModel(CLINICAL).fit(patients)
    assert again.stages[0].prep == prep
    vectors = again.stages[0].transform(raw).select("patient_id", vector_to_array(VECTOR).alias("x")).collect()
    plain = {r.patient_id: [float(r[c]) for c in NAMES] for r in prep.transform(raw).collect()}
    assert {r.patient_id: r.x for r in vectors} == plain


def test_stage_runs_on_a_stream_and_needs_a_fit(spark, patients, tmp_path):
    with pytest.raises(NotFittedError):
        stage_of(PrepModel(CLINICAL))
    with pytest.raises(NotFittedError):
        PrepStageModel().transform(patients)
    stage = PrepStage(CLINICAL).fit(patients)
    patients.write.parquet(str(tmp_path / "in"))
    stream = stage.transform(spark.readStream.schema(patients.schema).parquet(str(tmp_path / "in")))
    query = stream.select("patient_id", vector_to_array(VECTOR).alias("x")).writeStream.format("memory").queryName("staged").start()
    query.processAllAvailable()
    query.stop()
    batch = stage.transform(patients).select("patient_id", vector_to_array(VECTOR).alias("x"))
    assert sorted(spark.table("staged").collect()) == sorted(batch.collect())


# --- models as relations ------------------------------------------------------------


def exported(spark, model, family):
    return R.tree_nodes(spark, model) if family in L.SPACES else R.coefficients(spark, model, NAMES)


def scored_by_relation(ready, relation, family):
    if family in L.SPACES:
        return R.score_trees(ready, NAMES, relation, 4, boosted=family == "gradient_boosting")
    return R.score_linear(ready, relation)


TREE_SQL = """
with recursive x as (select patient_id, [{names}] as x from rows),
walk(patient_id, tree, node) as (
  select distinct patient_id, tree, 0 from x, nodes
  union all
  select w.patient_id, w.tree, case when x.x[n.feature + 1] <= n.threshold then n."left" else n."right" end
  from walk w join nodes n on n.tree = w.tree and n.node = w.node join x on x.patient_id = w.patient_id where n."left" >= 0),
leaves as (select w.patient_id, n.* from walk w join nodes n on n.tree = w.tree and n.node = w.node where n."left" < 0)
select patient_id, {value} as p from leaves group by patient_id"""
VALUES = {
    "random_forest": "avg(stats[2] / (stats[1] + stats[2]))",
    "gradient_boosting": "1 / (1 + exp(-2 * sum(weight * prediction)))",
}


@pytest.mark.parametrize("family", L.FAMILIES)
def test_relations_score_as_the_model_and_as_sql(spark, ready, fitted, tmp_path, family):
    model = fitted[family]
    relation = exported(spark, model, family)
    got = {r.patient_id: (r.probability, r.prediction) for r in scored_by_relation(ready, relation, family).collect()}
    want = {r.patient_id: (r.probability, r.prediction) for r in L.score(model, ready).collect()}
    assert got.keys() == want.keys()
    for k, (p, y) in want.items():
        assert got[k][0] == pytest.approx(p, abs=1e-9)
        assert got[k][1] == y or abs(p - 0.5) < 1e-9
    relation.write.parquet(str(tmp_path / "relation"))
    ready.write.parquet(str(tmp_path / "rows"))
    db = duckdb.connect()
    db.execute(f"create view rows as select * from '{tmp_path}/rows/*.parquet'")
    db.execute(f"create view nodes as select * from '{tmp_path}/relation/*.parquet'")
    if family in L.SPACES:
        sql = TREE_SQL.format(names=", ".join(f'"{c}"' for c in NAMES), value=VALUES[family])
    else:
        sum_sql = " + ".join(f'"{c}" * (select weight from nodes where feature = \'{c}\')' for c in NAMES)
        at = f"(select weight from nodes where position = {len(NAMES)} + {{}})"
        margin = f"({sum_sql} + {at.format(0)})"
        margin = f"({margin} * {at.format(1)} + {at.format(2)})" if family == "svm" else margin
        sql = f"select patient_id, 1 / (1 + exp(-{margin})) as p from rows"
    for k, p in db.execute(sql).fetchall():
        assert p == pytest.approx(want[k][0], abs=1e-9)


# --- certificates ---------------------------------------------------------------------


def test_linear_certificate_holds_and_fails_when_perturbed(spark, ready, fitted):
    weights = R.coefficients(spark, fitted["logistic_regression"], NAMES)
    n = ready.count()

    def gap(relation):
        rows = R.linear_certificate(ready, relation, "target", 1.0).collect()
        assert {r.feature for r in rows} == {*NAMES, None}
        return max(abs(r.observed - r.explained) / n for r in rows)

    assert gap(weights) < 1e-4
    for feature in (NAMES[0], NAMES[-1]):
        off = weights.withColumn("weight", F.col("weight") + F.when(F.col("feature") == feature, 0.2).otherwise(0.0))
        assert gap(off) > 1e-3


def test_boosting_certificate_holds_and_fails_when_perturbed(spark, ready, fitted):
    nodes = R.tree_nodes(spark, fitted["gradient_boosting"]).persist()

    def off(relation):
        rows = R.boosting_certificate(ready, NAMES, relation, "target", 3).collect()
        return sum(r.n != r.fitted_n or abs(r.total - r.fitted_total) > 1e-6 * max(1, abs(r.total)) for r in rows)

    assert off(nodes) == 0
    root = (F.col("tree") == 1) & (F.col("node") == 0)
    assert off(nodes.withColumn("threshold", F.when(root, F.col("threshold") + 0.7).otherwise(F.col("threshold")))) > 0
    leaf = (F.col("tree") == 0) & (F.col("left") < 0)
    assert off(nodes.withColumn("prediction", F.when(leaf, F.col("prediction") * 0.9).otherwise(F.col("prediction")))) > 0


def test_split_certificate_of_a_forest(spark, fitted):
    nodes = R.tree_nodes(spark, fitted["random_forest"])
    rows = R.split_certificate(nodes).collect()
    assert rows and all(r.sums_agree and r.gain == pytest.approx(r.recomputed, abs=1e-9) for r in rows)
    off = nodes.withColumn("stats", F.transform("stats", lambda s, i: s + F.when((F.col("node") == 1) & (i == 0), 1.0).otherwise(0.0)))
    assert not all(r.sums_agree for r in R.split_certificate(off).collect())


# --- calibration ------------------------------------------------------------------------


def slow_isotonic(y, n):
    return [max(min(sum(y[a : b + 1]) / sum(n[a : b + 1]) for b in range(i, len(y))) for a in range(i + 1)) for i in range(len(y))]


def test_isotonic_steps_match_the_max_min_formula(spark):
    rng = np.random.default_rng(4)
    p = rng.uniform(size=3000)
    rows = [(float(v), int(rng.uniform() < v * v)) for v in p] + [(None, 1), (0.5, None), (1.0, 1)]
    df = spark.createDataFrame(rows, "p double, y int")
    steps = C.isotonic_steps(df, "p", "y", 64)
    known = [(v, y) for v, y in rows if v is not None and y is not None]
    cells = sorted({int(v * 64) for v, _ in known})
    n = [sum(int(v * 64) == c for v, _ in known) for c in cells]
    y = [sum(lab for v, lab in known if int(v * 64) == c) for c in cells]
    want = dict(zip(cells, slow_isotonic(y, n)))
    got = C.apply_isotonic(df, steps, "p").collect()
    for r in got:
        assert r.calibrated is None if r.p is None else r.calibrated == pytest.approx(want[int(r.p * 64)])
    before = C.calibration_error(df, "p", "y").first()
    after = C.calibration_error(C.apply_isotonic(df, steps, "p"), "calibrated", "y").first()
    assert before.n == after.n == len(known) and after.error < before.error / 3
    empty = C.isotonic_steps(df.limit(0), "p", "y")
    assert empty.count() == 0 and C.apply_isotonic(df, empty, "p").where("calibrated is not null").count() == 0


def test_cross_fitted_margins_calibrate_better(spark):
    """Few rows, many noise columns: margins on the training rows are too sure, those of held-out folds are not."""
    rng = np.random.default_rng(8)
    names = [f"x{k}" for k in range(40)]

    def draw(n, start):
        x = rng.normal(size=(n, 40))
        y = rng.uniform(size=n) < 1 / (1 + np.exp(-x[:, 0] - x[:, 1]))
        return spark.createDataFrame([(start + i, float(y[i]), *map(float, x[i])) for i in range(n)], "id long, y double, " + ", ".join(f"{c} double" for c in names))

    train, test = draw(160, 0).persist(), draw(3000, 1000).persist()
    crossed = C.cross_fitted_svm(train, names, "y", ["id"])
    plain = L.train(train, "svm", names, "y")
    errors = [C.calibration_error(L.score(m, test), "probability", "y").first().error for m in (crossed, plain)]
    assert errors[0] < 0.8 * errors[1]
    margins = C.held_out_margins(train, names, "y", ["id"])
    assert margins.count() == 160 and {r.fold for r in margins.select("fold").distinct().collect()} == {0, 1, 2}
    again = C.held_out_margins(train.repartition(7), names, "y", ["id"])
    assert sorted(r.id for r in margins.where("fold = 1").collect()) == sorted(r.id for r in again.where("fold = 1").collect())
