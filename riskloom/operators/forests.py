"""Forests on weighted cells.

A tree sees only the bins of a row, so rows that agree in all bins and the label are one cell of n rows. A forest draws every row
Poisson(1) times for a tree, which makes Poisson(n) times for the cell; so a tree on cells with these draws as weights is
a tree of the same kind as on the rows, and its passes go over cells, which stop growing in number with the rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle, inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions that run in Python workers travel with the plan; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Trees whose draws are held at once, and trees that are fitted side by side.
TREES_HELD = 50
FITS = 8


def _draws(trees: list[int], names: list[str], weight: str, seed: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        generators = [np.random.default_rng([seed, tree, place]) for tree in trees]
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(weight)).to_numpy()
            drawn = [pa.array(g.poisson(rows), pa.int64()) for g in generators]
            yield pa.RecordBatch.from_arrays([*batch.columns, *drawn], names=[*batch.schema.names, *names])

    return run


def with_draws(cells: DataFrame, trees: list[int], weight: str, seed: int) -> DataFrame:
    """``cells`` and a column ``__d<tree>`` per tree: how often the tree draws the cell's rows, all copies together.

    Draws follow the seed, the tree and a cell's place, so ``cells`` must be in a stable layout.
    """
    names = [f"__d{tree}" for tree in trees]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema] + [f"{n} bigint" for n in names])
    return cells.mapInArrow(_draws(trees, names, weight, seed), schema)


def fit_on_cells(
    cells: DataFrame, features: list[str], label: str, weight: str, classes: int, forest: RandomForestClassifier
) -> RandomForestClassificationModel:
    """``forest`` fitted on the rows that ``cells`` (in a stable layout) stand for.

    Each tree is a fit of its own on the cells it draws, with the draws as weights; the trees make one model, with the forest's
    parameters. A side of a split holds ``minInstancesPerNode`` drawn rows at least, as on rows.
    """
    trees, seed, least = forest.getNumTrees(), forest.getSeed(), forest.getMinInstancesPerNode()
    tried = forest.getFeatureSubsetStrategy()
    if tried == "auto":
        tried = "all" if trees == 1 else "sqrt"
    vector = forest.getFeaturesCol()
    assembler = VectorAssembler(inputCols=list(features), outputCol=vector)
    named = F.col(f"`{label}`").alias(label, metadata={"ml_attr": {"type": "nominal", "num_vals": classes}})

    def one(drawn: DataFrame, tree: int, total: int):
        own = drawn.where(F.col(f"__d{tree}") > 0)
        own = assembler.transform(own).select(vector, named, F.col(f"__d{tree}").cast("double").alias(weight))
        single = forest.copy().setNumTrees(1).setBootstrap(False).setFeatureSubsetStrategy(tried).setWeightCol(weight)
        single = single.setSeed(seed + tree).setMinInstancesPerNode(1)
        if least > 1:  # instances are cells here, rows are their weights
            single = single.setMinWeightFractionPerNode(min((least - 0.5) / total, math.nextafter(0.5, 0)))
        return single.fit(own)._java_obj.trees()[0]

    grown = []
    for start in range(0, trees, TREES_HELD):
        group = list(range(start, min(start + TREES_HELD, trees)))
        drawn = with_draws(cells, group, weight, seed).persist()
        try:
            totals = drawn.agg(*[F.sum(f"__d{tree}") for tree in group]).first()
            with ThreadPoolExecutor(FITS) as pool:
                fit = inheritable_thread_target(cells.sparkSession)(one)
                futures = [pool.submit(fit, drawn, tree, total) for tree, total in zip(group, totals)]
                grown += [future.result() for future in futures]
        finally:
            drawn.unpersist()
    jvm, gateway = cells.sparkSession._jvm, cells.sparkSession.sparkContext._gateway
    kinds = jvm.org.apache.spark.ml.classification
    held = gateway.new_array(kinds.DecisionTreeClassificationModel, len(grown))
    for i, tree in enumerate(grown):
        held[i] = tree
    model = forest._copyValues(forest._create_model(kinds.RandomForestClassificationModel(forest.uid, held, len(features), classes)))
    model._transfer_params_to_java()
    return model
