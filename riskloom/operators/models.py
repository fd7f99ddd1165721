"""Distributed classifiers (MOD rows) on Spark ML pipelines."""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.forests import fit_on_cells
from riskloom.operators.metrics import performance
from riskloom.operators.ordered import order_statistics
from riskloom.operators.trials import validate_forests

FAMILIES = ("logistic_regression", "random_forest", "gradient_boosting", "svm")
LINEAR = ("logistic_regression", "svm")
SEED = 42
VECTOR = "features_vector"
WEIGHT = "__weight"

# Search ranges (inclusive). A Spark tree has no minimum split
# size, so that range of the original search is not represented.
SPACES: dict[str, dict[str, tuple]] = {
    "random_forest": {
        "n_estimators": (50, 300),
        "max_depth": (3, 20),
        "min_samples_leaf": (1, 10),
    },
    "gradient_boosting": {
        "n_estimators": (50, 200),
        "learning_rate": (0.01, 0.3),
        "max_depth": (3, 10),
    },
}
TRIALS = 50

DEFAULTS: dict[str, dict] = {
    "logistic_regression": {"max_iter": 1000, "c": 1.0},
    "random_forest": {"n_estimators": 100, "max_depth": 10, "min_samples_leaf": 1},
    "gradient_boosting": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3},
    "svm": {"max_iter": 1000, "c": 1.0},
}


# A fit's passes pay for each partition: a result to the driver, and in a forest the statistics of every open node. So
# partitions stay ``PARTITIONS`` in number until they are full, and then grow with the rows.
PARTITIONS = 24
ROWS_PER_PARTITION = 1_000_000
SMALL_PARTITION = 12_500
#: A forest is fitted on cells from so many rows a cell, on the rows below; and the cells of a partition then.
ROWS_PER_CELL = 4
CELLS_PER_PARTITION = 100_000
#: Places in trees (rows times trees) that a forest's fit keeps from level to level, four bytes each; it walks the trees anew above.
NODE_IDS = 1 << 29


def layout_partitions(rows: int) -> int:
    """One for ``SMALL_PARTITION`` rows up to ``PARTITIONS``, then one for ``ROWS_PER_PARTITION`` rows without an upper end."""
    return max(1, min(-(-rows // SMALL_PARTITION), PARTITIONS), -(-rows // ROWS_PER_PARTITION))


def stable_layout(
    df: DataFrame, key: list[str], partitions: int | None = None, rows: int | None = None
) -> DataFrame:
    """Fixed placement by key hash and fixed order, so a seeded tree fit sees the same rows every time.

    Neither the layout of the input nor a session setting moves a row. Without an explicit number there are
    ``layout_partitions``; ``rows`` saves a count when known.
    """
    if partitions is None:
        partitions = layout_partitions(df.count() if rows is None else rows)
    return df.repartition(partitions, *key).sortWithinPartitions(*key)


def distinct_rows(df: DataFrame, cols: list[str], weight: str = WEIGHT) -> DataFrame:
    """The distinct rows of ``cols`` and how many rows each stands for, as the double ``weight``.

    A weighted fit without row sampling on them is the fit on all rows: its sums are the same sums.
    """
    return df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).cast("double").alias(weight))


def laid_distinct(df: DataFrame, cols: list[str], rows: int) -> DataFrame:
    """``distinct_rows`` in a stable layout for ``rows`` rows, the number of ``df``'s or more than the distinct ones."""
    return stable_layout(distinct_rows(df, cols), cols, rows=rows)


def bin_edges(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Per feature the splits of a ``Bucketizer``: every value its own bin if they are at most ``bins``, else even quantiles.

    All rows are read and the quantiles are exact, so the same rows give the same bins from any layout.
    """
    value = {c: F.col(f"`{c}`").cast("double") for c in features}
    seen = df.agg(F.count(F.lit(1)).alias("n"), *[F.approx_count_distinct(v) for v in value.values()]).first()
    maybe = [c for c, k in zip(features, seen[1:]) if k <= 2 * bins]  # the estimate is good to a few per cent
    listed = df.agg(*[F.sort_array(F.collect_set(value[c])) for c in maybe]).first() if maybe else []
    few = {c: values for c, values in zip(maybe, listed) if len(values) <= bins}
    rest = [c for c in features if c not in few]
    ranks = lambda k: {k * i // bins for i in range(bins)}
    found = order_statistics(df.select(*[value[c].alias(c) for c in rest]), rest, ranks, seen["n"])[0] if rest else {}
    edges = []
    for c in features:
        distinct = sorted({v for v in few[c] if v == v} if c in few else set(found[c].values()))  # no NaN, one zero
        edges.append([-math.inf, *(distinct[1:] or [0.0]), math.inf])
    return edges


@dataclass
class Cells:
    """``frame``: rows that agree in all bins (``names``, whole numbers in the features' order) and the label are one weighted row."""

    bucketizer: Bucketizer
    names: list[str]
    frame: DataFrame


def binned_cells(df: DataFrame, features: list[str], label: str, bins: int) -> Cells:
    """The cells of ``df``. A tree only ever sees a row's bins; cells stop growing in number with the rows.

    Bins are numbers in order, not categories as the ``Bucketizer`` marks them.
    """
    names = [f"{c}__bin" for c in features]
    slim = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], F.col(label).cast("double").alias(label))
    bucketizer = Bucketizer(splitsArray=bin_edges(slim, features, bins), inputCols=list(features), outputCols=names)
    binned = bucketizer.transform(slim).select(*[F.col(f"`{c}`").cast("int").alias(c) for c in names], label)
    return Cells(bucketizer, names, distinct_rows(binned, [*names, label]))


def _fit_boosted(cells: Cells, label: str, params: dict, seed: int) -> PipelineModel:
    """Boosting on cells: rows alike have the same residual in every round, so the fit's passes, a few a round, go over cells."""
    stages, _ = _estimator("gradient_boosting", label, params, seed)
    return PipelineModel(stages=[cells.bucketizer, *weighted_fit(cells.frame, cells.names, label, stages).stages])


def _fit_forest(
    df: DataFrame, cells: Cells, features: list[str], label: str, params: dict, seed: int, key: list[str] | None
) -> PipelineModel:
    """A forest on cells, whose draws are those of their rows, or on the rows while these are few a cell."""
    n, rows, top = cells.frame.agg(F.count(F.lit(1)), F.sum(WEIGHT), F.max(label)).first()
    if rows is not None and rows >= ROWS_PER_CELL * n:
        forest = _estimator("random_forest", label, params, seed)[1]
        laid = stable_layout(cells.frame, [*cells.names, label], -(-n // CELLS_PER_PARTITION))
        assembler = VectorAssembler(inputCols=cells.names, outputCol=VECTOR)
        return PipelineModel(stages=[cells.bucketizer, assembler, fit_on_cells(laid, cells.names, label, WEIGHT, max(2, int(top) + 1), forest)])
    plan = pipeline("random_forest", features, label, params, seed)
    plan.getStages()[-1].setCacheNodeIds((rows or 0) * params["n_estimators"] <= NODE_IDS)
    if not key:
        return plan.fit(df)
    laid = stable_layout(df, key, rows=int(rows or 0)).persist()
    try:
        return plan.fit(laid)
    finally:
        laid.unpersist()


def _estimator(family: str, label: str, params: dict, seed: int):
    """(stages after the assembler, the stage that carries the search parameters)."""
    p = {**DEFAULTS[family], **params}
    if family == "logistic_regression":
        model = LogisticRegression(
            featuresCol=VECTOR,
            labelCol=label,
            maxIter=p["max_iter"],
            regParam=p.get("reg", 0.0),
            standardization=False,
            tol=p.get("tol", 1e-4),
        )
        return [model], model
    if family == "random_forest":
        model = RandomForestClassifier(
            featuresCol=VECTOR,
            labelCol=label,
            numTrees=p["n_estimators"],
            maxDepth=p["max_depth"],
            minInstancesPerNode=p["min_samples_leaf"],
            seed=seed,
        )
        return [model], model
    if family == "gradient_boosting":
        model = GBTClassifier(
            featuresCol=VECTOR,
            labelCol=label,
            maxIter=p["n_estimators"],
            stepSize=p["learning_rate"],
            maxDepth=p["max_depth"],
            seed=seed,
        )
        return [model], model
    if family == "svm":
        # Linear kernel; the margin is turned into a probability by a logistic fit on it.
        svc = LinearSVC(
            featuresCol=VECTOR,
            labelCol=label,
            maxIter=p["max_iter"],
            regParam=p.get("reg", 0.0),
            tol=1e-3,
            rawPredictionCol="margins",
            predictionCol="prediction",
        )
        slicer = VectorSlicer(inputCol="margins", outputCol="margin", indices=[1])
        platt = LogisticRegression(featuresCol="margin", labelCol=label, predictionCol="platt_prediction")
        return [svc, slicer, platt], svc
    raise ValueError(f"unknown family {family!r}; expected one of {FAMILIES}")


def family_stages(family: str, label: str, params: dict | None = None, seed: int = SEED) -> list:
    """The stages that follow the feature vector."""
    return _estimator(family, label, params or {}, seed)[0]


def pipeline(family: str, features: list[str], label: str, params: dict | None = None, seed: int = SEED) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol=VECTOR)
    stages, _ = _estimator(family, label, params or {}, seed)
    return Pipeline(stages=[assembler, *stages])


def _weighted_pipeline(features: list[str], stages: list) -> Pipeline:
    for stage in stages:
        if stage.hasParam("weightCol"):
            stage.setWeightCol(WEIGHT)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol=VECTOR), *stages])


def weighted_fit(cells: DataFrame, features: list[str], label: str, stages: list) -> PipelineModel:
    """The stages that take weights, fitted on ``distinct_rows`` in a stable layout."""
    return _weighted_pipeline(features, stages).fit(stable_layout(cells, [*features, label]))


def _fit_linear(
    df: DataFrame, family: str, features: list[str], label: str, params: dict, seed: int, weighted: bool
) -> PipelineModel:
    def penalised(cells: DataFrame) -> list:
        p = params
        if "c" in p:
            p = {**p, "reg": 1.0 / (p["c"] * max(cells.agg(F.sum(WEIGHT)).first()[0] or 0, 1))}
        return _estimator(family, label, p, seed)[0]

    slim = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], F.col(label).cast("double").alias(label), *[WEIGHT] * weighted)
    if weighted:
        return _weighted_pipeline(features, penalised(slim)).fit(slim)
    cells = distinct_rows(slim, [*features, label]).persist()
    try:
        return weighted_fit(cells, features, label, penalised(cells))
    finally:
        cells.unpersist()


def train(
    df: DataFrame,
    family: str,
    features: list[str],
    label: str,
    params: dict | None = None,
    seed: int = SEED,
    key: list[str] | None = None,
    cells: Cells | None = None,
    weighted: bool = False,
) -> PipelineModel:
    """Fit one family. An inverse strength ``c`` becomes Spark's mean-loss penalty ``1 / (c * rows)``.

    Linear fits go over weighted distinct rows, trees over weighted cells of equal bins (``cells`` if they are at hand). A forest
    with few rows a cell is fitted on the rows: as they lie, or with ``key`` in a stable layout. ``weighted``: the rows of ``df``
    have their weights and their layout already (``laid_distinct``), for a linear fit.
    """
    p = {**DEFAULTS[family], **(params or {})}
    if family in LINEAR:
        return _fit_linear(df, family, features, label, p, seed, weighted)
    tree_estimator = _estimator(family, label, p, seed)[1]
    used = cells or binned_cells(df, features, label, tree_estimator.getMaxBins())
    if not cells:
        used.frame.persist()
    try:
        if family == "gradient_boosting":
            return _fit_boosted(used, label, p, seed)
        return _fit_forest(df, used, features, label, p, seed, key)
    finally:
        if not cells:
            used.frame.unpersist()


def score(
    model: PipelineModel, df: DataFrame, prediction: str = "prediction", probability: str = "probability"
) -> DataFrame:
    """Input columns plus the 0/1 prediction and the positive-class probability. Works on streams too."""
    scored = model.transform(df)
    return scored.select(
        *df.columns,
        F.col("prediction").cast("int").alias(prediction),
        vector_to_array("probability")[1].alias(probability),
    )


@dataclass
class TrainedModel:
    family: str
    model: PipelineModel
    params: dict
    metrics: dict = field(default_factory=dict)


def evaluate(model: PipelineModel, df: DataFrame, label: str) -> dict[str, float]:
    """The five metrics of one model on one table."""
    scored = score(model, df).select(label, "prediction", "probability").persist()
    try:
        row = performance(scored, label, "prediction", "probability").first()
    finally:
        scored.unpersist()
    return {m: row[m] for m in ("accuracy", "precision", "recall", "f1_score", "roc_auc")}


def baselines(
    train_df: DataFrame,
    test_df: DataFrame,
    features: list[str],
    label: str,
    families: tuple[str, ...] = FAMILIES,
    params: dict[str, dict] | None = None,
    seed: int = SEED,
    key: list[str] | None = None,
    distinct: DataFrame | None = None,
) -> list[TrainedModel]:
    """Fit every family on the same training rows and evaluate it on the test rows.

    The families are fitted side by side: boosting is many short jobs one after the other, which leave cores to the others. Both
    families of trees share the cells of the training rows. ``distinct``: the training rows once more, as weighted distinct rows in a
    stable layout, for the linear fits; ``key`` as for ``train``.
    """
    chosen = params or {}
    shared = None
    if any(f in SPACES for f in families):
        bins = {_estimator(f, label, {}, seed)[1].getMaxBins() for f in families if f in SPACES}
        shared = binned_cells(train_df, features, label, *bins)
        shared.frame.persist()

    def one(family: str) -> TrainedModel:
        linear = distinct is not None and family in LINEAR
        rows = distinct if linear else train_df
        model = train(rows, family, features, label, chosen.get(family), seed, key, shared, linear)
        return TrainedModel(
            family, model, {**DEFAULTS[family], **chosen.get(family, {})}, evaluate(model, test_df, label)
        )

    try:
        with ThreadPoolExecutor(max(1, len(families))) as pool:
            # each thread gets its own copy of the caller's local properties
            futures = [pool.submit(inheritable_thread_target(train_df.sparkSession)(one), family) for family in families]
            return [future.result() for future in futures]
    finally:
        if shared:
            shared.frame.unpersist()


RESULT_SCHEMA = (
    "position int, model string, accuracy double, precision double, recall double, f1_score double, roc_auc double"
)


def results_table(spark: SparkSession, trained: list[TrainedModel]) -> DataFrame:
    """One metrics row per model."""
    rows = [
        (i, t.family, *[t.metrics[m] for m in ("accuracy", "precision", "recall", "f1_score", "roc_auc")])
        for i, t in enumerate(trained)
    ]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def draw_trials(space: dict[str, tuple], n: int, seed: int) -> list[dict]:
    """Seeded random draws inside the inclusive ranges."""
    rng = random.Random(seed)
    return [
        {
            name: rng.randint(lo, hi) if isinstance(lo, int) and isinstance(hi, int) else rng.uniform(lo, hi)
            for name, (lo, hi) in space.items()
        }
        for _ in range(n)
    ]


_SPARK_NAMES = {
    "random_forest": {"n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode"},
    "gradient_boosting": {"n_estimators": "maxIter", "learning_rate": "stepSize", "max_depth": "maxDepth"},
}


def search(
    train_df: DataFrame,
    family: str,
    features: list[str],
    label: str,
    trials: int = TRIALS,
    space: dict[str, tuple] | None = None,
    parallelism: int = 2,
    seed: int = SEED,
) -> TrainedModel | None:
    """Random search on a validation part of the training rows, by F1 of the positive class.

    The winner is refitted on all training rows with the seed kept; the test
    rows are never seen here. Families without a search space return None. Forests are validated
    on cells of equal bins while these are few enough (``trials.CELLS``), else by a fit on the rows for each trial.
    """
    space = space or SPACES.get(family)
    if not space:
        return None
    if family == "random_forest":
        drawn = [{**DEFAULTS[family], **t} for t in draw_trials(space, trials, seed)]
        edges = bin_edges(train_df, features, _estimator(family, label, {}, seed)[1].getMaxBins())
        scores = validate_forests(train_df, features, label, edges, drawn, 0.8, seed)
        if scores is not None:
            best = max(range(len(scores)), key=lambda i: (scores[i], -i))
            params = {k: drawn[best][k] for k in space}
            model = train(train_df, family, features, label, params, seed)
            return TrainedModel(family, model, params, {"validation_f1": scores[best]})
    assembler = VectorAssembler(inputCols=list(features), outputCol=VECTOR)
    stages, tuned = _estimator(family, label, {}, seed)
    names = _SPARK_NAMES[family]
    drawn = draw_trials(space, trials, seed)
    grid = [{tuned.getParam(names[k]): v for k, v in t.items()} for t in drawn]
    evaluator = MulticlassClassificationEvaluator(
        labelCol=label, predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0
    )
    fitted = TrainValidationSplit(
        estimator=Pipeline(stages=[assembler, *stages]),
        estimatorParamMaps=grid,
        evaluator=evaluator,
        trainRatio=0.8,
        parallelism=parallelism,
        seed=seed,
    ).fit(train_df)
    scores = list(fitted.validationMetrics)
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    return TrainedModel(family, fitted.bestModel, drawn[best], {"validation_f1": scores[best]})


def importances(model: PipelineModel, features: list[str], spark: SparkSession) -> DataFrame:
    """``(feature, importance)``, non-negative and summing to 1 (tree families)."""
    tree = next(s for s in model.stages if hasattr(s, "featureImportances"))
    values = tree.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(features, values)), "feature string, importance double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
