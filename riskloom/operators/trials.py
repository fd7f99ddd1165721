"""Validation of many forests at once.

A tree sees only the bins of a row, so rows that agree in all bins are one cell with counts of either label. Cells stop
growing in number with the rows; they are counted by Spark from all rows and sent to every task, and each task
grows and validates the forests of its trials on them. A cell of n rows is drawn Poisson(n) times for a tree, which is
what n rows drawn Poisson(1) times make together, so a forest is one of the same kind as on the rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions that run in Python workers travel with the plan; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells that every task holds at most.
CELLS = 1 << 17
_COUNTS = ("__train0", "__train1", "__valid0", "__valid1")


def cells(df: DataFrame, features: list[str], label: str, edges: list[list[float]], ratio: float, seed: int) -> DataFrame:
    """(bins, counts of either label among training and validation rows, count of all rows) per distinct row of bins.

    A share of ``ratio`` of the rows, drawn by ``seed``, is for training.
    """
    binned = [f"{c}__bin" for c in features]
    slim = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], F.col(label).cast("double").alias("__y"))
    bucketizer = Bucketizer(splitsArray=edges, inputCols=list(features), outputCols=binned)
    sided = bucketizer.transform(slim.withColumn("__in", F.rand(seed) < ratio))
    y, inside = F.col("__y"), F.col("__in")
    wanted = (inside & (y == 0), inside & (y == 1), ~inside & (y == 0), ~inside & (y == 1))
    counts = [F.count_if(w).alias(name) for w, name in zip(wanted, _COUNTS)]
    return sided.groupBy(*[F.col(f"`{c}`") for c in binned]).agg(*counts, F.count(F.lit(1)).alias("__n"))


def grow_tree(codes: np.ndarray, drawn: np.ndarray, depth: int, leaf: int, tried: int, rng) -> np.ndarray:
    """Chance of label 1 for every cell by one tree on ``drawn`` (copies of either label), grown level by level by Gini gain.

    Each node tries ``tried`` features; either side of a split holds at least ``leaf`` drawn rows.
    """
    bins = int(codes.max(initial=0)) + 1
    chance, rows, node, nodes = np.zeros(len(codes)), np.arange(len(codes)), np.zeros(len(codes), np.int64), 1
    for level in range(depth + 1):
        zeros, ones = drawn[rows, 0], drawn[rows, 1]
        zero, one = np.bincount(node, zeros, nodes), np.bincount(node, ones, nodes)
        n = np.maximum(zero + one, 1)
        chance[rows] = (one / n)[node]
        if level == depth:
            break
        mask = rng.random((nodes, codes.shape[1])).argsort(1).argsort(1) < tried
        best, feature, cut = np.zeros(nodes), np.full(nodes, -1), np.zeros(nodes, np.int64)
        for f in range(codes.shape[1]):
            at = node * bins + codes[rows, f]
            left0, left1 = (np.bincount(at, w, nodes * bins).reshape(nodes, bins).cumsum(1)[:, :-1] for w in (zeros, ones))
            right0, right1 = zero[:, None] - left0, one[:, None] - left1
            left, right = left0 + left1, right0 + right1
            allowed = (left >= leaf) & (right >= leaf) & mask[:, f, None]
            impure = left0 * left1 / np.maximum(left, 1) + right0 * right1 / np.maximum(right, 1)
            gain = np.where(allowed, (zero * one / n)[:, None] - impure, 0.0)
            if not gain.shape[1]:
                continue
            at = gain.argmax(1)
            top = gain[np.arange(nodes), at]
            better = top > best
            best, feature, cut = np.where(better, top, best), np.where(better, f, feature), np.where(better, at, cut)
        split = feature >= 0
        if not split.any():
            break
        goes = split[node]
        rows, node = rows[goes], node[goes]
        right = codes[rows, feature[node]] > cut[node]
        node = (split.cumsum() - 1)[node] * 2 + right
        nodes = 2 * int(split.sum())
    return chance


def forest_chances(codes: np.ndarray, train: np.ndarray, trial: dict, seed) -> np.ndarray:
    """Chance of label 1 for every cell, averaged over the trees of a forest."""
    trees = trial["n_estimators"]
    tried = codes.shape[1] if trees == 1 else math.ceil(math.sqrt(codes.shape[1]))
    total = np.zeros(len(codes))
    for tree in range(trees):
        rng = np.random.default_rng([*seed, tree])
        total += grow_tree(codes, rng.poisson(train), trial["max_depth"], trial["min_samples_leaf"], tried, rng)
    return total / trees


def positive_f1(chances: np.ndarray, valid: np.ndarray) -> float:
    """F1 of label 1 over counts of either label."""
    positive = chances > 0.5
    hit, false, missed = valid[positive, 1].sum(), valid[positive, 0].sum(), valid[~positive, 1].sum()
    return float(2 * hit / (2 * hit + false + missed)) if hit else 0.0


def validate_forests(
    df: DataFrame, features: list[str], label: str, edges: list[list[float]], trials: list[dict], ratio: float, seed: int
) -> list[float] | None:
    """F1 of label 1 on the validation rows for every trial; None when there are over ``CELLS`` cells or other labels."""
    spark = df.sparkSession
    counted = cells(df, features, label, edges, ratio, seed).persist()
    try:
        found = counted.agg(F.count(F.lit(1)), F.sum("__n"), F.sum(sum((F.col(c) for c in _COUNTS), F.lit(0)))).first()
        if not 0 < found[0] <= CELLS or found[1] != found[2]:
            return None
        held = counted.drop("__n").toArrow()  # at most CELLS rows
    finally:
        counted.unpersist()
    table = np.column_stack([held.column(i).to_numpy() for i in range(held.num_columns)]).astype(np.int64)
    table = table[np.lexsort(table[:, : len(features)].T)]  # the same order from any layout
    shared = spark.sparkContext.broadcast((table[:, : len(features)], table[:, -4:-2], table[:, -2:]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, train, valid = shared.value
        for batch in batches:
            mine = batch.column(0).to_pylist()
            scores = [positive_f1(forest_chances(codes, train, trials[i], (seed, i)), valid) for i in mine]
            yield pa.RecordBatch.from_arrays([pa.array(mine, pa.int64()), pa.array(scores, pa.float64())], names=["id", "f1"])

    try:
        scored = spark.range(0, len(trials), 1, len(trials)).mapInArrow(run, "id bigint, f1 double").collect()  # a row a trial
    finally:
        shared.destroy()
    return [r["f1"] for r in sorted(scored, key=lambda r: r["id"])]
