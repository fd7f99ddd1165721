"""DataFrame-level projections (PRJ rows of the inventory). No shuffles here."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.config import RISK_CUTS, RISK_LABELS, Bounds, FeatureConfig
from riskloom.functions import (
    clip_column,
    confidence_of,
    cut_column,
    dummy_columns,
    flag_above,
    linear_score_of,
    nan_to_null,
    ratio_of,
    recommendation_of,
    risk_category_of,
    zero_to_missing,
)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map; names that are absent are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def binary_label(df: DataFrame, col: str, positive: str, out: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(col) == F.lit(positive), F.lit(False)).cast("int"))


def linear_score(df: DataFrame, weights: dict[str, float], out: str) -> DataFrame:
    return df.withColumn(out, linear_score_of(weights))


def percentile_label(df: DataFrame, score: str | Column, pct: float, out: str) -> DataFrame:
    """1 where the score is strictly above its ``pct`` percentile.

    The cut is one number found by :func:`riskloom.operators.ordered.percentiles`
    (a checked switch between the built-in exact percentile and a distributed
    selection), so no task ever holds the whole column.
    """
    from riskloom.operators.ordered import percentile_values

    tmp = "__score"
    scored = df.withColumn(tmp, F.expr(score) if isinstance(score, str) else score)
    cut = percentile_values(scored, [tmp], [pct])[tmp][0]
    test = F.lit(False) if cut is None else F.coalesce(F.col(tmp) > F.lit(cut), F.lit(False))
    return scored.withColumn(out, test.cast("int")).drop(tmp)


def clip(df: DataFrame, bounds: Bounds) -> DataFrame:
    return df.withColumns({c: clip_column(c, lo, hi) for c, (lo, hi) in bounds.items() if c in df.columns})


def features(df: DataFrame, exclude: list[str]) -> DataFrame:
    """Everything but the label (and any other excluded column)."""
    return df.select(*[c for c in df.columns if c not in set(exclude)])


def resolve(df: DataFrame, aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """Give each logical column its standard name, taking the first alias present."""
    renames = {}
    for name, candidates in aliases.items():
        found = next((c for c in candidates if c in df.columns), None)
        if found and found != name:
            renames[found] = name
    return df.withColumnsRenamed(renames) if renames else df


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in all floating columns."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(c) for c in floating}) if floating else df


def zero_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """0 means missing in the listed columns; absent columns are skipped."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: zero_to_missing(c) for c in present}) if present else df


def cut(df, col, edges, labels, out, closed="right", include_lowest=False) -> DataFrame:
    return df.withColumn(out, cut_column(col, edges, labels, closed, include_lowest))


def dummies(df: DataFrame, spec: dict[str, list[str]], drop_first: bool = True, unknown: bool = False) -> DataFrame:
    """Replace each category column by booleans named ``column_label``."""
    kept = [F.col(c) for c in df.columns if c not in spec]
    flags = [flag for c, labels in spec.items() for flag in dummy_columns(c, labels, c, drop_first, unknown)]
    return df.select(*kept, *flags)


def interaction(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(a) * F.col(b))


def safe_ratio(df: DataFrame, a: str, b: str, out: str, eps: float = 1e-8) -> DataFrame:
    return df.withColumn(out, ratio_of(a, b, eps))


def flag_gt(df: DataFrame, col: str, threshold: float, out: str) -> DataFrame:
    return df.withColumn(out, flag_above(col, threshold))


def dedup_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name."""
    if max(Counter(df.columns).values(), default=1) == 1:
        return df
    unique = [f"__{i}" for i in range(len(df.columns))]
    first: dict[str, str] = {}
    for tmp, name in zip(unique, df.columns):
        first.setdefault(name, tmp)
    return df.toDF(*unique).select(*[F.col(tmp).alias(name) for name, tmp in first.items()])


def align(df: DataFrame, names: list[str], fill: float = 0) -> DataFrame:
    """Exactly these columns in this order: missing ones filled, extra ones dropped."""
    have = set(df.columns)
    return df.select(*[F.col(n) if n in have else F.lit(fill).alias(n) for n in names])


def numeric_features(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    """Numeric column names; booleans are not numeric, excluded names are left out."""
    drop = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in drop]


def stamp(df: DataFrame, run_ts, model_version: str | None = None, ts_col: str = "prediction_timestamp") -> DataFrame:
    """Stamp a run time and version that are passed in, so a rerun gives the same rows."""
    out = df.withColumn(ts_col, F.lit(run_ts).cast("timestamp"))
    return out if model_version is None else out.withColumn("model_version", F.lit(model_version))


def engineer(df: DataFrame, cfg: FeatureConfig, clean: bool = True) -> DataFrame:
    """Clean, bin, encode and derive in one projection.

    Dummies come from the cleaned but not yet imputed values. Derived products
    and ratios stay NULL when an input is NULL and are imputed later with their
    own median. Columns outside the feature list (key, label) pass through.
    """
    df = resolve(df, cfg.aliases) if cfg.aliases else df
    if clean:
        df = zero_to_null(nulls_for_nan(df), list(cfg.zero_missing))
    other = [F.col(c) for c in df.columns if c not in cfg.features]
    derived = [(F.col(a) * F.col(b)).alias(out) for a, b, out in cfg.products]
    derived += [ratio_of(a, b, cfg.epsilon).alias(out) for a, b, out in cfg.ratios]
    derived += [flag_above(c, k).alias(out) for c, k, out in cfg.flags]
    for b in cfg.bins:
        label = cut_column(b.column, b.edges, b.labels, b.closed, b.include_lowest)
        derived += dummy_columns(label, b.labels, b.out, True, cfg.unknown_flags)
    return df.select(*other, *[F.col(c) for c in cfg.features], *derived)


def confidence(df: DataFrame, p: str = "probability", out: str = "confidence_score") -> DataFrame:
    return df.withColumn(out, confidence_of(p))


def risk_category(
    df: DataFrame,
    p: str = "probability",
    cuts=RISK_CUTS,
    labels=RISK_LABELS,
    closed: str = "left",
    out: str = "risk_category",
    advice: dict[str, str] | None = None,
) -> DataFrame:
    """Risk band and, when ``advice`` is given, the recommendation text."""
    result = df.withColumn(out, risk_category_of(p, cuts, labels, closed))
    return result if advice is None else result.withColumn("recommendation", recommendation_of(out, advice))
