import time

import numpy as np
import pytest
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from riskloom.operators import models as L
from riskloom.operators import trials as T


@pytest.fixture(scope="module")
def noisy(spark):
    """4,000 rows, two informative features, one of noise, a tenth of the labels turned over."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 40, (4000, 3)).astype(float)
    y = ((x[:, 0] + x[:, 1] > 40) ^ (rng.random(4000) < 0.1)).astype(float)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double").repartition(3).persist()


def test_cells_count_every_row_once(spark, noisy):
    edges = L.bin_edges(noisy, ["a", "b"], 8)
    found = T.cells(noisy, ["a", "b"], "y", edges, 0.8, 1).toPandas()
    assert found["__n"].sum() == 4000 and len(found) == 64
    assert (found[["__train0", "__train1", "__valid0", "__valid1"]].sum(axis=1) == found["__n"]).all()
    assert 3000 < found[["__train0", "__train1"]].to_numpy().sum() < 3400
    want = Bucketizer(splitsArray=edges, inputCols=["a", "b"], outputCols=["p", "q"]).transform(noisy)
    want = want.groupBy("p", "q").agg(F.sum("y").alias("ones")).toPandas().set_index(["p", "q"])["ones"]
    got = found.assign(ones=found["__train1"] + found["__valid1"]).set_index(["a__bin", "b__bin"])["ones"]
    assert (got.sort_index().to_numpy() == want.sort_index().to_numpy()).all()


def test_one_tree_by_hand():
    codes = np.array([[0, 0], [1, 0], [2, 0], [3, 0]])
    drawn = np.array([[4, 0], [3, 1], [0, 4], [0, 0]])  # the last cell is drawn by no tree and still gets a chance
    rng = np.random.default_rng(0)
    assert T.grow_tree(codes, drawn, 1, 1, 2, rng).tolist() == [0.125, 0.125, 1.0, 1.0]
    assert T.grow_tree(codes, drawn, 2, 1, 2, rng).tolist() == [0.0, 0.25, 1.0, 1.0]
    assert T.grow_tree(codes, drawn, 9, 5, 2, rng).tolist() == [5 / 12] * 4  # no side of 5 rows beside one of 5
    assert T.grow_tree(codes, drawn, 0, 1, 2, rng).tolist() == [5 / 12] * 4


def test_forests_on_cells_agree_with_forests_on_rows(spark, noisy):
    """The same parameters on the same side of the same draw, by Spark's forest."""
    names, trial = ["a", "b", "c"], {"n_estimators": 40, "max_depth": 6, "min_samples_leaf": 5}
    (f1,) = T.validate_forests(noisy, names, "y", L.bin_edges(noisy, names, 32), [trial], 0.8, 7)
    sided = noisy.withColumn("inside", F.rand(7) < 0.8)
    model = L.train(sided.where("inside"), "random_forest", names, "y", trial)
    assert f1 == pytest.approx(L.evaluate(model, sided.where("not inside"), "y")["f1_score"], abs=0.02)


def test_search_of_forests_is_one_pass_over_rows(spark, noisy, monkeypatch):
    """All 50 trials of the library's ranges; fits on the rows took over a minute."""
    names, fits = ["a", "b", "c"], []
    monkeypatch.setattr(L, "TrainValidationSplit", lambda **_: pytest.fail("a fit on the rows for each trial"))
    real = L.train
    monkeypatch.setattr(L, "train", lambda *a, **k: fits.append(a) or real(*a, **k))
    tuned = L.search(noisy, "random_forest", names, "y")
    assert len(fits) == 1 and fits[0][0] is noisy
    assert tuned.params in L.draw_trials(L.SPACES["random_forest"], 50, L.SEED)
    assert tuned.metrics["validation_f1"] > 0.85


def test_search_over_too_many_cells_fits_on_the_rows(spark, noisy, monkeypatch):
    monkeypatch.setattr(T, "CELLS", 10)
    space = {"n_estimators": (2, 3), "max_depth": (2, 3), "min_samples_leaf": (1, 2)}
    tuned = L.search(noisy, "random_forest", ["a", "b"], "y", trials=2, space=space)
    assert set(tuned.params) == set(space) and tuned.metrics["validation_f1"] > 0.5


def test_baselines_fit_side_by_side(spark, noisy, monkeypatch):
    running, most = [0], [0]

    def slow(*args, **kwargs):
        running[0] += 1
        most[0] = max(most[0], running[0])
        time.sleep(0.5)
        running[0] -= 1

    monkeypatch.setattr(L, "train", slow)
    monkeypatch.setattr(L, "evaluate", lambda *a: {"accuracy": 1.0})
    found = L.baselines(noisy, noisy, ["a", "b"], "y")
    assert [t.family for t in found] == list(L.FAMILIES) and most[0] == len(L.FAMILIES)
