"""Fitted models as relations: nodes and coefficients as tables, scoring by joins, certificates of a fit (MOD-1..4, MOD-10).

A tree ensemble becomes a table of nodes, a linear model a table of coefficients. Either is a few rows beside the data, can be kept
with other tables, and scores rows by a join and built-in functions, without the library that fitted it. The
certificates recompute from the training rows what a fit must satisfy, and so fail on a changed or stale model.
"""

from __future__ import annotations

import math
import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LinearSVCModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import shared_dir

COEFFICIENTS = "position int, feature string, weight double"
_TREES = (RandomForestClassificationModel, GBTClassificationModel)


def fitted_stage(model: PipelineModel, kinds):
    """The first stage of one of ``kinds``; a model that is one itself is that stage."""
    for stage in getattr(model, "stages", [model]):
        if isinstance(stage, kinds):
            return stage
    raise ValueError(f"no stage of {kinds} in the model")


def tree_nodes(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(tree, node, left, right, feature, threshold, prediction, n, stats, gain, weight) of a forest or a boosted ensemble.

    ``left`` and ``right`` are -1 in a leaf; ``stats`` are the row weights per class in a forest, and count, sum and sum of
    squares of the residuals in a boosted tree; ``n`` is the rows' weight. Features are continuous; of trees on bins, the thresholds
    are those of the features. Nodes count from 0, the root, in every tree.
    """
    stage = fitted_stage(model, _TREES)
    path = shared_dir(spark, "models", uuid.uuid4().hex)
    stage.write().save(path)
    weights = spark.createDataFrame(list(enumerate(map(float, stage.treeWeights))), "tree int, weight double")
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    stats, feature = F.col("impurityStats"), F.col("split.featureIndex")
    threshold = F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0))
    binned = next((s for s in getattr(model, "stages", []) if isinstance(s, Bucketizer)), None)
    if binned is not None:
        edges = spark.createDataFrame(
            [(f, b, math.nextafter(e, -math.inf)) for f, cuts in enumerate(binned.getSplitsArray()) for b, e in enumerate(cuts[1:])],
            "edge_feature int, bin int, edge double",
        )
        # bins up to b hold what lies below the edge b + 1; a few rows a feature
        own = (feature == F.col("edge_feature")) & (F.floor(threshold) == F.col("bin"))
        nodes, threshold = nodes.join(F.broadcast(edges), own, "left"), F.col("edge")
    rows = F.get(stats, F.lit(0)) if isinstance(stage, GBTClassificationModel) else F.aggregate(stats, F.lit(0.0), lambda s, x: s + x)
    return nodes.join(F.broadcast(weights), "tree").select(  # a row a tree
        "tree",
        F.col("id").alias("node"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        feature.alias("feature"),
        threshold.alias("threshold"),
        "prediction",
        F.round(rows).cast("bigint").alias("n"),
        stats.alias("stats"),
        "gain",
        "weight",
    )


def coefficients(spark: SparkSession, model: PipelineModel, features: list[str]) -> DataFrame:
    """(position, feature, weight): of a linear model, its intercept last under a null feature.

    For the linear SVM these give the margin; ``(1, "margin")`` and its intercept are the second step's, under positions
    from ``len(features) + 1``.
    """
    stage = fitted_stage(model, (LinearSVCModel, LogisticRegressionModel))
    rows = [(i, f, float(w)) for i, (f, w) in enumerate(zip(features, stage.coefficients))]
    rows.append((len(features), None, float(stage.intercept)))
    if isinstance(stage, LinearSVCModel):
        platt = fitted_stage(model, LogisticRegressionModel)
        rows += [(len(rows), "margin", float(platt.coefficients[0])), (len(rows) + 1, None, float(platt.intercept))]
    return spark.createDataFrame(rows, COEFFICIENTS)


def packed_trees(nodes: DataFrame) -> DataFrame:
    """One row: ``trees``, an array with the node columns of each tree as arrays in node order, and the greatest ``steps``.

    As large as the model, whatever the data.
    """
    in_order = F.sort_array(F.collect_list(F.struct("node", "left", "right", "feature", "threshold", "prediction", "stats")))
    trees = nodes.groupBy("tree", "weight").agg(in_order.alias("nodes"))
    fields = ["tree", "weight", *(F.col(f"nodes.{c}").alias(c) for c in ("left", "right", "feature", "threshold", "prediction", "stats"))]
    return trees.select(F.struct(*fields).alias("tree")).agg(F.sort_array(F.collect_list("tree")).alias("trees"))


def _leaf(tree: Column, x: Column, steps: int) -> Column:
    """Node where the row's walk through ``tree`` ends."""

    def step(at: Column, _: Column) -> Column:
        left = F.get(tree["left"], at)
        goes_left = F.get(x, F.get(tree["feature"], at)) <= F.get(tree["threshold"], at)
        return F.when(left < 0, at).when(goes_left, left).otherwise(F.get(tree["right"], at))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, steps))), F.lit(0), step)


def with_leaves(df: DataFrame, features: list[str], nodes: DataFrame, steps: int) -> DataFrame:
    """``df`` with ``__x`` (features as an array), ``__trees`` and ``__leaves``: the leaf reached in each tree.

    The model is one row that every scored row meets over the model's name; ``steps`` is at least the trees' depth.
    """
    named = packed_trees(nodes).select(F.lit("model").alias("__model"), F.col("trees").alias("__trees"))
    rows = df.withColumns({"__model": F.lit("model"), "__x": F.array(*[F.col(c).cast("double") for c in features])})
    met = rows.join(F.broadcast(named), "__model").drop("__model")  # as large as the model
    return met.withColumn("__leaves", F.transform("__trees", lambda t: _leaf(t, F.col("__x"), steps)))


def score_trees(df: DataFrame, features: list[str], nodes: DataFrame, steps: int, boosted: bool) -> DataFrame:
    """``df`` plus ``probability`` and ``prediction`` from a table of nodes.

    A forest averages the class shares of its leaves; a boosted ensemble adds weighted leaf values to half a log-odds.
    """
    met = with_leaves(df, features, nodes, steps)
    if boosted:
        value = F.zip_with("__trees", "__leaves", lambda t, k: t["weight"] * F.get(t["prediction"], k))
        margin = F.aggregate(value, F.lit(0.0), lambda s, v: s + v)
        probability = 1 / (1 + F.exp(-2 * margin))
    else:

        def share(t: Column, k: Column) -> Column:
            stats = F.get(t["stats"], k)
            return F.get(stats, F.lit(1)) / (F.get(stats, F.lit(0)) + F.get(stats, F.lit(1)))

        value = F.zip_with("__trees", "__leaves", share)
        probability = F.aggregate(value, F.lit(0.0), lambda s, v: s + v) / F.size("__trees")
    scored = met.withColumn("probability", probability).drop("__x", "__trees", "__leaves")
    return scored.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


def score_linear(df: DataFrame, weights: DataFrame) -> DataFrame:
    """``df`` plus ``probability`` and ``prediction`` from a table of coefficients (a row a feature, read by the driver).

    The prediction is the margin's sign, whatever a second step makes of its size.
    """
    rows = weights.orderBy("position").collect()
    ends = [i for i, r in enumerate(rows) if r.feature is None]
    value = F.lit(0.0)
    for r in rows[: ends[0]]:
        value = value + F.col(r.feature).cast("double") * F.lit(r.weight)
    value = margin = value + F.lit(rows[ends[0]].weight)
    if len(ends) == 2:  # the margin's second step
        value = value * F.lit(rows[ends[0] + 1].weight) + F.lit(rows[ends[1]].weight)
    return df.withColumns({"probability": 1 / (1 + F.exp(-value)), "prediction": (margin > 0).cast("int")})


def linear_certificate(df: DataFrame, weights: DataFrame, label: str, c: float) -> DataFrame:
    """(feature, observed, explained): the first-order conditions of a penalised logistic fit with inverse strength ``c``.

    At the optimum the feature's sum over positive rows equals its expected sum plus its penalty, weight / c; the
    intercept, under a null feature, has none. Both come from one aggregation over the training rows.
    """
    rows = weights.orderBy("position").collect()  # a row a feature
    scored = score_linear(df, weights)
    sums = []
    for i, r in enumerate(rows):
        x = F.lit(1.0) if r.feature is None else F.col(r.feature).cast("double")
        penalty = 0.0 if r.feature is None else r.weight / c
        sums += [F.sum(x * F.col(label)).alias(f"o{i}"), (F.sum(x * F.col("probability")) + F.lit(penalty)).alias(f"e{i}")]
    wide = scored.agg(*sums)
    parts = [F.struct(F.lit(r.feature).alias("feature"), F.col(f"o{i}").alias("observed"), F.col(f"e{i}").alias("explained")) for i, r in enumerate(rows)]
    return wide.select(F.inline(F.array(*parts)))


def boosting_certificate(df: DataFrame, features: list[str], nodes: DataFrame, label: str, steps: int) -> DataFrame:
    """(tree, node, n, total, fitted_n, fitted_total) of every leaf of a boosted ensemble.

    ``n`` and ``total`` are rows and summed residuals found by sending the training rows through the trees, each tree's residual
    following from those before it; a sound model has the same numbers stored.
    """
    met = with_leaves(df.withColumn("__y", 2.0 * F.col(label) - 1.0), features, nodes, steps)
    values = F.zip_with("__trees", "__leaves", lambda t, k: t["weight"] * F.get(t["prediction"], k))

    def residual(i: Column) -> Column:
        so_far = F.aggregate(F.slice(F.col("__values"), F.lit(1), i), F.lit(0.0), lambda s, v: s + v)
        y = F.col("__y")
        return F.when(i == 0, y).otherwise(4 * y / (1 + F.exp(2 * y * so_far)))

    valued = met.withColumn("__values", values)
    each = F.transform("__leaves", lambda k, i: F.struct(i.alias("tree"), k.alias("node"), residual(i).alias("r")))
    found = valued.select(F.inline(each)).groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), F.sum("r").alias("total"))
    stored = nodes.where("left < 0").select(
        "tree", "node", F.col("n").alias("fitted_n"), F.get("stats", F.lit(1)).alias("fitted_total")
    )
    return found.join(stored, ["tree", "node"], "full")


def split_certificate(nodes: DataFrame) -> DataFrame:
    """(tree, node, sums_agree, gain, recomputed) of every inner node: children add up to it, and its gain follows from them.

    For a forest, whose trees see their own draws of rows.
    """
    def gini(stats: Column) -> Column:
        total = F.get(stats, F.lit(0)) + F.get(stats, F.lit(1))
        p = F.get(stats, F.lit(1)) / total
        return 2 * p * (1 - p)

    inner = nodes.where("left >= 0").select("tree", "node", "left", "right", "stats", "gain")
    child = nodes.select("tree", F.col("node").alias("child"), F.col("stats").alias("s"))
    both = inner.join(child.withColumnsRenamed({"child": "left", "s": "a"}), ["tree", "left"]).join(
        child.withColumnsRenamed({"child": "right", "s": "b"}), ["tree", "right"]
    )
    size = lambda s: F.get(s, F.lit(0)) + F.get(s, F.lit(1))
    again = gini(F.col("stats")) - (size(F.col("a")) * gini(F.col("a")) + size(F.col("b")) * gini(F.col("b"))) / size(F.col("stats"))
    agree = F.forall(F.zip_with(F.zip_with("a", "b", lambda x, y: x + y), F.col("stats"), lambda x, y: x == y), lambda same: same)
    return both.select("tree", "node", agree.alias("sums_agree"), "gain", again.alias("recomputed"))
