"""Preprocessing as a stage of a Spark ML ``Pipeline``: one saved object holds preparation and model (§2.13)."""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import FeatureConfig
from riskloom.operators.models import DEFAULTS, SEED, VECTOR, family_stages, train
from riskloom.operators.prep import NotFittedError, PrepModel, config_from_dict, config_to_dict

_RAW = "__raw"


class _PrepParams(Params):
    """Everything a stage knows, as text, so Spark's own metadata file saves it."""

    config = Param(Params._dummy(), "config", "the feature configuration as JSON", TypeConverters.toString)
    approx = Param(Params._dummy(), "approx", "approximate percentiles", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "the vector of prepared features", TypeConverters.toString)

    @property
    def cfg(self) -> FeatureConfig:
        return config_from_dict(json.loads(self.getOrDefault(self.config)))

    @property
    def feature_names(self) -> list[str]:
        return self.cfg.output


class PrepStageModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Raw rows in, the same rows plus the feature vector out. A narrow projection, so it also runs on streams."""

    statistics = Param(Params._dummy(), "statistics", "medians and scaling as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(approx=False, outputCol=VECTOR)

    @property
    def prep(self) -> PrepModel:
        if not self.isSet(self.statistics):
            raise NotFittedError("Preprocessor must be fitted before transform")
        saved = json.loads(self.getOrDefault(self.statistics))
        scaling = {c: tuple(v) for c, v in saved["scaling"].items()}
        return PrepModel(self.cfg, saved["medians"], scaling, self.getOrDefault(self.approx))

    def _transform(self, df: DataFrame) -> DataFrame:
        prep, out = self.prep, self.getOrDefault(self.outputCol)
        carried = df.withColumn(_RAW, F.struct(*[F.col(f"`{c}`") for c in df.columns]))
        ready = prep.transform(carried).select(_RAW, *[F.col(c).cast("double").alias(c) for c in prep.feature_names])
        assembled = VectorAssembler(inputCols=prep.feature_names, outputCol=out).transform(ready)
        return assembled.select(f"{_RAW}.*", out)


class PrepStage(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits medians and scaling on the rows it is given."""

    def __init__(self, cfg: FeatureConfig | None = None, approx: bool = False, outputCol: str = VECTOR):
        super().__init__()
        self._setDefault(approx=False, outputCol=VECTOR)
        self._set(approx=approx, outputCol=outputCol)
        if cfg is not None:
            self._set(config=json.dumps(config_to_dict(cfg)))

    def _fit(self, df: DataFrame) -> PrepStageModel:
        return stage_of(PrepModel(self.cfg, approx=self.getOrDefault(self.approx)).fit(df), self.getOrDefault(self.outputCol))


def stage_of(prep: PrepModel, output: str = VECTOR) -> PrepStageModel:
    """An already fitted preprocessing as a stage."""
    if not prep.is_fitted:
        raise NotFittedError("Preprocessor must be fitted before it becomes a stage")
    model = PrepStageModel()
    statistics = json.dumps({"medians": prep.medians, "scaling": {c: list(v) for c, v in prep.scaling.items()}})
    return model._set(
        config=json.dumps(config_to_dict(prep.cfg)), approx=prep.approx, outputCol=output, statistics=statistics
    )


def scoring_pipeline(
    cfg: FeatureConfig, family: str, params: dict | None = None, rows: int | None = None, seed: int = SEED
) -> Pipeline:
    """Unfitted pipeline from raw rows to probabilities.

    ``rows`` turns an inverse strength ``c`` into the mean-loss penalty, as ``models.train`` does. The margins of
    the linear SVM are calibrated on its training rows here; ``calibration.cross_fitted_svm`` does it apart.
    """
    p = {**DEFAULTS[family], **(params or {})}
    if "c" in p and rows:
        p["reg"] = 1.0 / (p["c"] * rows)
    return Pipeline(stages=[PrepStage(cfg), *family_stages(family, cfg.label, p, seed)])


def fit_scoring(df: DataFrame, cfg: FeatureConfig, family: str, params: dict | None = None, seed: int = SEED) -> PipelineModel:
    """``scoring_pipeline`` fitted on ``df``: medians and scaling from all rows, linear models over distinct rows."""
    if family not in ("logistic_regression", "svm"):
        return scoring_pipeline(cfg, family, params, df.count(), seed).fit(df)
    prep = PrepModel(cfg).fit(df)
    ready = prep.transform(df).select(cfg.label, *[F.col(c).cast("double").alias(c) for c in prep.feature_names])
    fitted = train(ready, family, prep.feature_names, cfg.label, params, seed)
    return PipelineModel(stages=[stage_of(prep), *fitted.stages[1:]])
