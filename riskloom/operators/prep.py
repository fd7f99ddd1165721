"""Median imputation and robust scaling with frozen statistics (FIT-2..6, SNK-5)."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.config import Bin, FeatureConfig
from riskloom.operators.ordered import interpolated, order_statistics, percentile_values, ranks_around
from riskloom.operators.projection import engineer

STATS_SCHEMA = "position int, feature string, median double, center double, scale double"


class NotFittedError(ValueError):
    """Transform was called before fit."""


def fit_impute(df: DataFrame, cols: list[str], approx: bool = False, n: int | None = None) -> dict[str, float]:
    """Median per column. A column without any value is an error."""
    medians = {c: v[0] for c, v in percentile_values(df, cols, [0.5], approx, n=n).items()}
    empty = [c for c, v in medians.items() if v is None]
    if empty:
        raise ValueError(f"columns without any value cannot be imputed: {empty}")
    return medians


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()})


def fit_scale(
    df: DataFrame, medians: dict[str, float], approx: bool = False, n: int | None = None
) -> dict[str, tuple[float, float]]:
    """(centre, scale) per column on *imputed* values; a zero quartile range scales by 1."""
    cols = list(medians)
    quartiles = percentile_values(impute(df.select(*cols), medians), cols, [0.25, 0.5, 0.75], approx, n=n)
    return {c: (q2, (q3 - q1) or 1.0) for c, (q1, q2, q3) in quartiles.items()}


def fit_statistics(
    df: DataFrame, cols: list[str], n: int
) -> tuple[dict[str, float], dict[str, tuple[float, float]]]:
    """Medians and the scaling of the imputed columns from one selection.

    Imputing inserts one copy of the median per missing row right after the
    lower middle value, so every rank of the imputed column is either the median
    or a known rank of the original column. The data need not be read again.
    """
    quartiles = (0.25, 0.5, 0.75)

    def source_rank(r: int, k: int) -> int | None:
        """Rank in the ``k`` original values, None for an inserted median."""
        middle = math.floor(0.5 * (k - 1))
        if r <= middle:
            return r
        return None if r <= middle + n - k else r - (n - k)

    def wanted(k: int) -> set[int]:
        ranks = set().union(*[ranks_around(q * (n - 1)) for q in quartiles])
        return ranks_around(0.5 * (k - 1)) | {s for s in (source_rank(r, k) for r in ranks) if s is not None}

    found, present = order_statistics(df, cols, wanted, n)
    empty = [c for c in cols if not present[c]]
    if empty:
        raise ValueError(f"columns without any value cannot be imputed: {empty}")
    medians, scaling = {}, {}
    for c in cols:
        k = present[c]
        medians[c] = interpolated(found[c], 0.5 * (k - 1))

        def at(r: int) -> float:
            s = source_rank(r, k)
            return medians[c] if s is None else found[c][s]

        q1, q2, q3 = (
            interpolated({r: at(r) for r in ranks_around(q * (n - 1))}, q * (n - 1)) for q in quartiles
        )
        scaling[c] = (q2, (q3 - q1) or 1.0)
    return medians, scaling


def impute_scale(df: DataFrame, medians: dict[str, float], scaling: dict[str, tuple[float, float]]) -> DataFrame:
    """Projection only: ``(coalesce(x, median) - centre) / scale`` with the numbers as literals."""
    return df.withColumns(
        {
            c: (F.coalesce(F.col(c).cast("double"), F.lit(m)) - F.lit(scaling[c][0])) / F.lit(scaling[c][1])
            for c, m in medians.items()
        }
    )


def config_to_dict(cfg: FeatureConfig) -> dict:
    return asdict(cfg)


def config_from_dict(raw: dict) -> FeatureConfig:
    """The configuration whose fields went through JSON, tuples restored."""
    return FeatureConfig(
        **{
            **raw,
            "features": tuple(raw["features"]),
            "zero_missing": tuple(raw["zero_missing"]),
            "bins": tuple(Bin(**{**b, "edges": tuple(b["edges"]), "labels": tuple(b["labels"])}) for b in raw["bins"]),
            "products": tuple(map(tuple, raw["products"])),
            "ratios": tuple(map(tuple, raw["ratios"])),
            "flags": tuple(map(tuple, raw["flags"])),
            "aliases": {k: tuple(v) for k, v in raw["aliases"].items()},
            "key": tuple(raw["key"]),
        }
    )


@dataclass
class PrepModel:
    """Fitted preprocessing state: a few numbers per feature, no data."""

    cfg: FeatureConfig
    medians: dict[str, float] | None = None
    scaling: dict[str, tuple[float, float]] | None = None
    approx: bool = False

    @property
    def is_fitted(self) -> bool:
        return self.medians is not None and self.scaling is not None

    @property
    def feature_names(self) -> list[str]:
        return self.cfg.output

    def fit(self, df: DataFrame) -> PrepModel:
        engineered = engineer(df, self.cfg).select(*self.cfg.numeric)
        if self.approx:
            medians = fit_impute(engineered, self.cfg.numeric, True)
            scaling = fit_scale(engineered, medians, True)
        else:
            medians, scaling = fit_statistics(engineered, self.cfg.numeric, df.count())
        return PrepModel(self.cfg, medians, scaling, self.approx)

    def transform(self, df: DataFrame) -> DataFrame:
        """Same rows, pass-through columns first, then the frozen feature list in order."""
        if not self.is_fitted:
            raise NotFittedError("Preprocessor must be fitted before transform")
        engineered = engineer(df, self.cfg)
        names = set(self.cfg.output)
        other = [c for c in engineered.columns if c not in names]
        scaled = impute_scale(engineered, self.medians, self.scaling)
        return scaled.select(*other, *self.cfg.output)

    def fit_transform(self, df: DataFrame) -> tuple[PrepModel, DataFrame]:
        fitted = self.fit(df)
        return fitted, fitted.transform(df)

    def stats(self, spark: SparkSession) -> DataFrame:
        if not self.is_fitted:
            raise NotFittedError("Preprocessor must be fitted first")
        rows = [(i, c, self.medians[c], *self.scaling[c]) for i, c in enumerate(self.cfg.numeric)]
        return spark.createDataFrame(rows, STATS_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.stats(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")
        config = json.dumps({"cfg": config_to_dict(self.cfg), "approx": self.approx})
        spark.createDataFrame([(config,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/config")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PrepModel:
        saved = json.loads(spark.read.text(f"{path}/config", wholetext=False).first()["value"])
        stats = spark.read.parquet(f"{path}/stats").collect()
        return cls(
            config_from_dict(saved["cfg"]),
            {r["feature"]: r["median"] for r in stats},
            {r["feature"]: (r["center"], r["scale"]) for r in stats},
            saved["approx"],
        )


def prepare(train: DataFrame, test: DataFrame, cfg: FeatureConfig, approx: bool = False):
    """Fit on the training part only; returns (model, train, test)."""
    model = PrepModel(cfg, approx=approx).fit(train)
    return model, model.transform(train), model.transform(test)
