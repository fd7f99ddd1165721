"""Calibrated probabilities: margins of held-out folds, Platt's step on them, and isotonic steps (MOD-4)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.models import DEFAULTS, VECTOR, WEIGHT, distinct_rows, weighted_fit

FOLDS = 3
#: Distinct scores, after rounding, that the isotonic fit holds at most.
STEPS = 1024
STEP_SCHEMA = "step int, low double, high double, n bigint, value double"


def fold_of(key: list[str], folds: int = FOLDS, seed: int = 42) -> Column:
    """Fold of a row by its key, whatever the layout: hex digits of a hash, modulo the folds."""
    text = F.concat_ws(";", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("n")) for k in key])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % folds).cast("int")


def _svc(label: str, params: dict, rows: int) -> LinearSVC:
    return LinearSVC(
        featuresCol=VECTOR,
        labelCol=label,
        maxIter=params["max_iter"],
        regParam=1.0 / (params["c"] * max(rows, 1)),
        tol=params.get("tol", 1e-3),
        rawPredictionCol="margins",
        predictionCol="prediction",
    )


def held_out_margins(
    df: DataFrame, features: list[str], label: str, key: list[str], folds: int = FOLDS, params: dict | None = None
) -> DataFrame:
    """``df`` plus ``fold`` and ``margins``, each row's from a linear SVM that was fitted on the other folds.

    The folds are scored in one plan; ``df`` is read once to combine equal rows of a fold, which the fits go over, and
    once to score.
    """
    p = {**DEFAULTS["svm"], **(params or {})}
    keyed = VectorAssembler(inputCols=list(features), outputCol=VECTOR).transform(df).withColumn("fold", fold_of(key, folds))
    cells = distinct_rows(keyed, ["fold", *features, label], WEIGHT).persist()
    try:
        sizes = {r.fold: int(r.n) for r in cells.groupBy("fold").agg(F.sum(WEIGHT).alias("n")).collect()}  # a row a fold
        parts = []
        for k in sorted(sizes):
            others = sum(n for f, n in sizes.items() if f != k)
            model = weighted_fit(cells.where(F.col("fold") != k), features, label, [_svc(label, p, others)]).stages[-1]
            parts.append(model.transform(keyed.where(F.col("fold") == k)))
    finally:
        cells.unpersist()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def cross_fitted_svm(
    df: DataFrame, features: list[str], label: str, key: list[str], folds: int = FOLDS, params: dict | None = None
) -> PipelineModel:
    """The family ``svm`` with Platt's step fitted on margins of held-out folds; the margin's model sees all rows."""
    p = {**DEFAULTS["svm"], **(params or {})}
    slicer = VectorSlicer(inputCol="margins", outputCol="margin", indices=[1])
    platt = LogisticRegression(featuresCol="margin", labelCol=label, predictionCol="platt_prediction", tol=1e-9)
    held_out = slicer.transform(held_out_margins(df, features, label, key, folds, p).select("margins", label)).persist()
    try:
        step = platt.fit(held_out)
    finally:
        held_out.unpersist()
    assembler = VectorAssembler(inputCols=list(features), outputCol=VECTOR)
    margins = Pipeline(stages=[assembler, _svc(label, p, df.count())]).fit(df)
    return PipelineModel(stages=[*margins.stages, slicer, step])


def isotonic_steps(df: DataFrame, score: str, label: str, steps: int = STEPS) -> DataFrame:
    """(step, low, high, n, value): the non-decreasing step function of the score nearest to the labels.

    Rows are first combined per cell of a grid of ``steps`` equal widths over [0, 1], at every size; the cells then become
    the blocks of pool-adjacent-violators. Null scores or labels take no part.
    """
    cells = F.floor(F.col(score) * steps) / steps
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    grouped = known.groupBy(cells.alias("cell")).agg(
        F.min(score).alias("low"), F.max(score).alias("high"), F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("double")).alias("y")
    )
    blocks: list[list] = []
    for r in grouped.orderBy("cell").collect():  # ``steps`` + 1 rows at most for scores in [0, 1]
        blocks.append([r.low, r.high, r.n, r.y])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            _, high, n, y = blocks.pop()
            blocks[-1] = [blocks[-1][0], high, blocks[-1][2] + n, blocks[-1][3] + y]
    rows = [(i, float(low), float(high), n, y / n) for i, (low, high, n, y) in enumerate(blocks)]
    return df.sparkSession.createDataFrame(rows, STEP_SCHEMA)


def apply_isotonic(df: DataFrame, steps: DataFrame, score: str, out: str = "calibrated") -> DataFrame:
    """The value of the last step that begins at or below the score; below the first step, the first one's."""
    rows = steps.orderBy("step").collect()  # at most the fit's number of cells
    if not rows:
        return df.withColumn(out, F.lit(None).cast("double"))
    lows, values = F.array(*[F.lit(r.low) for r in rows]), F.array(*[F.lit(r.value) for r in rows])
    passed = F.size(F.filter(lows, lambda low: low <= F.col(score)))
    return df.withColumn(out, F.when(F.col(score).isNotNull(), F.element_at(values, F.greatest(passed, F.lit(1)))))


def calibration_error(df: DataFrame, probability: str, label: str, bins: int = 10) -> DataFrame:
    """(n, error): mean absolute gap between probability and label rate over equal-width bins, weighted by rows."""
    cell = F.least(F.floor(F.col(probability) * bins), F.lit(bins - 1))
    known = df.where(F.col(probability).isNotNull() & F.col(label).isNotNull())
    grouped = known.groupBy(cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("k"), F.avg(probability).alias("p"), F.avg(F.col(label).cast("double")).alias("y")
    )
    return grouped.agg(F.sum("k").alias("n"), (F.sum(F.col("k") * F.abs(F.col("p") - F.col("y"))) / F.sum("k")).alias("error"))


