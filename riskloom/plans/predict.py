"""Batch scoring job: validate, score, categorise, write, summarise."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import BATCH_BOUNDS, NON_NEGATIVE, RISK_CUTS, RISK_LABELS, Bounds
from riskloom.functions import confidence_of, risk_category_of
from riskloom.operators.models import score
from riskloom.operators.prep import PrepModel
from riskloom.operators.profile import prediction_summary
from riskloom.operators.projection import stamp
from riskloom.operators.validation import negatives, outliers, require_columns
from riskloom.sources.sinks import write_summary, write_table


@dataclass
class PredictResult:
    predictions: DataFrame
    summary: DataFrame
    negatives: DataFrame
    outliers: DataFrame


def score_table(
    df: DataFrame,
    prep: PrepModel,
    model: PipelineModel,
    prediction: str = "prediction",
    probability: str = "probability",
    closed: str = "right",
) -> DataFrame:
    """Raw columns plus prediction, probability, confidence and risk category.

    One narrow plan: the raw row travels along as a struct while its features
    are prepared, so nothing has to be joined back. Works on streams.
    """
    require_columns(df, list(prep.cfg.features))
    carried = df.withColumn("__raw", F.struct(*[F.col(c) for c in df.columns]))
    ready = prep.transform(carried).select(
        "__raw", *[F.col(c).cast("double").alias(c) for c in prep.feature_names]
    )
    scored = score(model, ready, "__prediction", "__probability")
    return scored.select("__raw.*", F.col("__prediction").alias(prediction), F.col("__probability").alias(probability)).withColumns(
        {
            "confidence_score": confidence_of(probability),
            "risk_category": risk_category_of(probability, RISK_CUTS, RISK_LABELS, closed),
        }
    )


def predict(
    df: DataFrame,
    prep: PrepModel,
    model: PipelineModel,
    out: str,
    run_ts,
    model_version: str = "1",
    bounds: Bounds = BATCH_BOUNDS,
    non_negative: tuple[str, ...] = NON_NEGATIVE,
) -> PredictResult:
    """Score a table into ``out/predictions`` and its summary into ``out/summary``.

    The summary reads the written table, so the model runs once per row.
    """
    spark = df.sparkSession
    require_columns(df, list(prep.cfg.features))
    scored = stamp(score_table(df, prep, model), run_ts, model_version)
    write_table(scored, f"{out}/predictions")
    written = spark.read.parquet(f"{out}/predictions")
    summary = stamp(prediction_summary(written), run_ts)
    write_summary(summary, f"{out}/summary")
    return PredictResult(written, summary, negatives(df, list(non_negative)), outliers(df, bounds))
