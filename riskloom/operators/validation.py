"""Row and batch validation (FIL rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import BATCH_LIMIT, LOW_CONFIDENCE, Bounds
from riskloom.functions import range_errors, range_violation


class MissingColumnsError(ValueError):
    """A required column is absent."""


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"Missing required columns: {missing}")
    return df


def _per_column(df: DataFrame, tests: dict[str, object], out: str) -> DataFrame:
    """One aggregation for all columns, then one row per column."""
    row = df.agg(*[F.count_if(test).alias(f"__{i}") for i, test in enumerate(tests.values())])
    pairs = [F.struct(F.lit(name).alias("feature"), F.col(f"__{i}").alias(out)) for i, name in enumerate(tests)]
    return row.select(F.inline(F.array(*pairs)))


def negatives(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(feature, n_negative)`` per column."""
    return _per_column(df, {c: F.col(c) < F.lit(0) for c in cols}, "n_negative")


def outliers(df: DataFrame, bounds: Bounds) -> DataFrame:
    """``(feature, n_outliers)``; missing values are not outliers."""
    tests = {c: range_violation(c, lo, hi, "pass") for c, (lo, hi) in bounds.items()}
    return _per_column(df, tests, "n_outliers")


def row_errors(df: DataFrame, bounds: Bounds, null_policy: str = "fail", out: str = "errors") -> DataFrame:
    return df.withColumn(out, range_errors(bounds, null_policy))


def quarantine(
    df: DataFrame, bounds: Bounds, null_policy: str = "fail", out: str = "errors"
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their messages): two filters over one narrow plan."""
    checked = row_errors(df, bounds, null_policy, out)
    return checked.where(F.col(out).isNull()).drop(out), checked.where(F.col(out).isNotNull())


def in_domain(df: DataFrame, col: str, values: list, out: str = "in_domain") -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(col).isin(list(values)), F.lit(False)))


def low_confidence(df: DataFrame, threshold: float = LOW_CONFIDENCE, col: str = "confidence_score") -> DataFrame:
    return df.withColumn("low_confidence", F.col(col) < F.lit(threshold))


def batch_size_ok(df: DataFrame, key: str, lo: int = 1, hi: int = BATCH_LIMIT) -> DataFrame:
    """``(key, n_members, size_ok)``: counts are combined map-side, so a huge batch is cheap."""
    sizes = df.groupBy(key).agg(F.count("*").alias("n_members"))
    return sizes.withColumn("size_ok", F.col("n_members").between(lo, hi))


def batch_verdict(
    df: DataFrame, batch_key: str, bounds: Bounds, null_policy: str = "fail", limit: int = BATCH_LIMIT
) -> DataFrame:
    """One row per batch: accepted only if its size is legal and every member is valid.

    Only counts are aggregated, never member rows, so a batch that holds a third
    of the table still reduces map-side. The messages themselves are rows of
    :func:`batch_errors`.
    """
    bad = range_errors(bounds, null_policy).isNotNull()
    agg = df.groupBy(batch_key).agg(F.count("*").alias("n_members"), F.count_if(bad).alias("n_invalid"))
    return agg.withColumn("accepted", (F.col("n_invalid") == 0) & F.col("n_members").between(1, limit))


def batch_errors(
    df: DataFrame, batch_key: str, member: list[str], bounds: Bounds, null_policy: str = "fail"
) -> DataFrame:
    """Every message of every invalid member, one row each; a narrow plan without any shuffle."""
    checked = row_errors(df, bounds, null_policy)
    return checked.where(F.col("errors").isNotNull()).select(batch_key, *member, "errors")
