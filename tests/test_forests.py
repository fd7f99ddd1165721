"""Forests on cells: the same kind of forest as on rows, and passes that do not grow with every row."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from bindings.base import FEATURES, KEY, LINES, QUERIES
from riskloom.operators import forests as G
from riskloom.operators import models as L
from riskloom.operators import ordered as O
from riskloom.operators import relations as R

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def noisy(spark):
    """12,000 rows in at most 3,000 cells: two informative features, one of noise, a tenth of the labels turned over."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (12_000, 3)).astype(float)
    y = ((x[:, 0] + x[:, 1] > 11) ^ (rng.random(12_000) < 0.1)).astype(float)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double").repartition(3).persist()


@pytest.fixture
def on_cells(monkeypatch):
    monkeypatch.setattr(L, "ROWS_PER_CELL", 0)


def test_a_forest_sees_no_rows_when_cells_are_few(spark, noisy, monkeypatch):
    """Before, every tree went over every row."""
    monkeypatch.setattr(L, "pipeline", lambda *a, **k: pytest.fail("a fit on the rows"))
    seen, real = [], G.fit_on_cells

    def counted(cells, features, label, weight, *rest):
        seen.append(cells.agg(F.count("*"), F.sum(weight)).first())
        return real(cells, features, label, weight, *rest)

    monkeypatch.setattr(L, "fit_on_cells", counted)
    model = L.train(noisy, "random_forest", NAMES, "y", {"n_estimators": 5})
    assert seen[0][0] <= 12**3 * 2 and seen[0][1] == 12_000
    assert model.stages[-1].getNumTrees == 5 and model.stages[-1].getMaxDepth() == 10
    importances = model.stages[-1].featureImportances.toArray()
    assert importances.sum() == pytest.approx(1) and importances[2] == importances.min()


def test_draws_have_the_moments_of_rows_drawn_one_by_one(spark):
    cells = spark.range(20_000).select((F.col("id") % 2 * 49 + 1).cast("double").alias("w"), "id").coalesce(1)
    drawn = G.with_draws(cells, [0, 1], "w", 3).toPandas()
    for tree in ("__d0", "__d1"):
        for n in (1, 50):
            own = drawn.loc[drawn["w"] == n, tree]
            assert own.mean() == pytest.approx(n, rel=0.05) and own.var() == pytest.approx(n, rel=0.1)
    assert (drawn["__d0"] != drawn["__d1"]).any()
    assert drawn.equals(G.with_draws(cells, [0, 1], "w", 3).toPandas())


@pytest.mark.parametrize("leaf", [1, 40])
def test_forests_on_cells_agree_with_forests_on_rows(spark, noisy, monkeypatch, leaf):
    params, side = {"n_estimators": 20, "max_depth": 6, "min_samples_leaf": leaf}, F.col("id") % 4 > 0
    found = {}
    for kind, limit in (("cells", 0), ("rows", 1e9)):
        monkeypatch.setattr(L, "ROWS_PER_CELL", limit)
        model = L.train(noisy.where(side), "random_forest", NAMES, "y", params)
        assert isinstance(model.stages[0], Bucketizer) == (kind == "cells")
        found[kind] = L.evaluate(model, noisy.where(~side), "y"), R.tree_nodes(spark, model).where("left < 0").agg(F.min("n"), F.avg("n")).first()
    assert found["cells"][0] == pytest.approx(found["rows"][0], abs=0.02)
    assert min(found[k][1][0] for k in found) >= leaf
    assert found["cells"][1][1] == pytest.approx(found["rows"][1][1], rel=0.25)


def test_the_same_forest_from_any_layout_and_after_saving(spark, noisy, on_cells, tmp_path):
    params = {"n_estimators": 4, "max_depth": 5}
    edges = L.bin_edges(noisy, NAMES, 32)
    scores = []
    for k, df in enumerate((noisy, noisy.repartition(7).sortWithinPartitions("c"))):
        assert L.bin_edges(df, NAMES, 32) == edges
        model = L.train(df, "random_forest", NAMES, "y", params)
        model.write().save(str(tmp_path / str(k)))
        for m in (model, PipelineModel.load(str(tmp_path / str(k)))):
            scores.append([r.probability for r in L.score(m, noisy).orderBy("id").collect()])
    assert scores[0] == scores[1] == scores[2] == scores[3]
    relation = R.score_trees(noisy, NAMES, R.tree_nodes(spark, model), 5, boosted=False).orderBy("id").collect()
    assert [r.probability for r in relation] == pytest.approx(scores[0], abs=1e-9)


@pytest.mark.parametrize("rows_per_bucket", [100_000, 500])
def test_bins_are_exact_from_any_layout(spark, monkeypatch, rows_per_bucket):
    """Before, a sketch chose them, whose result depends on the order in which its parts meet."""
    monkeypatch.setattr(O, "ROWS_PER_BUCKET", rows_per_bucket)
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.lognormal(0, 2, 15_000), np.full(5_000, 0.5)])
    rows = [(float(v), float(i % 7), float(i == 3), 4.0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, few double, rare double, same double").persist()
    found = L.bin_edges(df, ["x", "few", "rare", "same"], 32)
    ranks = sorted({float(np.sort(x)[len(x) * i // 32]) for i in range(32)})
    assert found[0][1:-1] == ranks[1:] and found[1][1:-1] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    assert found[2][1:-1] == [1.0] and found[3][1:-1] == [0.0]
    assert L.bin_edges(df.repartition(11), ["x", "few", "rare", "same"], 32) == found
    monkeypatch.setattr(O, "MANY_RANKS", 0)
    assert L.bin_edges(df, ["x", "few", "rare", "same"], 32) == found


def test_bins_are_numbers_in_order_not_categories(spark, noisy):
    """As categories, a split may part the bins of one feature in any way, which no threshold does."""
    cells = L.binned_cells(noisy, NAMES, "y", 32)
    assert not any(f.metadata for f in cells.frame.select(*cells.names).schema)
    model = L.train(noisy, "gradient_boosting", NAMES, "y", {"n_estimators": 3})
    assert " in {" not in model.stages[-1].toDebugString


def test_feature_importances_lay_out_no_rows(spark, sf, monkeypatch, on_cells):
    """Before, all training rows were sorted by their keys and every tree went over them."""
    keys, real = [], L.stable_layout
    monkeypatch.setattr(L, "stable_layout", lambda df, key, *a, **k: keys.append(key) or real(df, key, *a, **k))
    monkeypatch.setitem(L.DEFAULTS, "random_forest", {"n_estimators": 3, "max_depth": 4, "min_samples_leaf": 1})
    found = QUERIES["feature_importances"](spark, sf).collect()
    assert {r.feature for r in found} == set(LINES.output) and sum(r.importance for r in found) == pytest.approx(1, abs=1e-4)
    assert keys and not any(KEY[0] in key for key in keys)


def test_baselines_bin_the_rows_once(spark, sf, monkeypatch, on_cells):
    """Before, each family of trees binned or laid out all rows for itself, and the linear fits each counted distinct prepared rows."""
    small = {"random_forest": {"n_estimators": 3, "max_depth": 4, "min_samples_leaf": 1}, "gradient_boosting": {"n_estimators": 2, "learning_rate": 0.1, "max_depth": 2}}
    for family, params in small.items():
        monkeypatch.setitem(L.DEFAULTS, family, params)
    binned, counted, bins, distinct = [], [], L.bin_edges, L.distinct_rows
    monkeypatch.setattr(L, "bin_edges", lambda *a: binned.append(a) or bins(*a))
    monkeypatch.setattr(L, "distinct_rows", lambda df, cols, *a: counted.append(cols) or distinct(df, cols, *a))
    rows = QUERIES["baselines"](spark, sf).collect()
    assert {r.model for r in rows} == set(L.FAMILIES) and sum(r.is_best for r in rows) == 1
    assert all(r.accuracy > 0.9 for r in rows)
    assert len(binned) == 1
    assert sorted(map(len, counted)) == [len(FEATURES) + 1, len(LINES.output) + 1]


def test_svm_holds_no_prepared_rows(spark, sf, monkeypatch):
    """Before, prepared training and test rows were held, and the distinct rows went through two exchanges with all prepared features."""
    frame = type(spark.range(0))
    held, real = [], frame.persist
    monkeypatch.setattr(frame, "persist", lambda df, *a: held.append(df.columns) or real(df, *a))
    (row,) = QUERIES["svm"](spark, sf).collect()
    assert row.model == "svm" and row.accuracy > 0.9
    assert held and not any((set(LINES.output) - set(FEATURES)) & set(cols) for cols in held)
    assert not any(KEY[0] in cols for cols in held)
