"""Group rates and demographic parity (AGG-9..11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_rates(df: DataFrame, group: str, prediction: str, keys: list[str] = ()) -> DataFrame:
    """Positive-prediction rate per group; rows without a group are left out."""
    known = df.where(F.col(group).isNotNull())
    return known.groupBy(*keys, group).agg(
        F.count("*").alias("n"), F.avg(F.col(prediction).cast("double")).alias("rate")
    )


def parity_difference(df: DataFrame, group: str, prediction: str, keys: list[str] = ()) -> DataFrame:
    """Largest minus smallest group rate; groups that have no rows do not exist here."""
    rates = group_rates(df, group, prediction, keys)
    gap = (F.max("rate") - F.min("rate")).alias("parity_difference")
    return rates.groupBy(*keys).agg(gap) if keys else rates.agg(gap)


def fairness_rates(
    df: DataFrame, specs: dict[str, str | Column], prediction: str, label: str | None = None
) -> DataFrame:
    """Rates for a list of sensitive features in one pass.

    ``specs`` maps a feature name to its group column or expression. Rows are
    stacked to (feature, group) and reduced by one aggregation with map-side
    combine, so a dominant group costs no more than any other.
    """
    cells = [
        F.struct(
            F.lit(name).alias("feature"),
            (F.col(g) if isinstance(g, str) else g).cast("string").alias("grp"),
        )
        for name, g in specs.items()
    ]
    keep = [F.col(prediction).cast("double").alias("__pred")]
    if label:
        keep.append(F.col(label).cast("double").alias("__label"))
    long = df.select(*keep, F.inline(F.array(*cells))).where(F.col("grp").isNotNull())
    aggs = [F.count("*").alias("n"), F.avg("__pred").alias("rate")]
    if label:
        aggs.append(F.avg("__label").alias("label_mean"))
    return long.groupBy("feature", "grp").agg(*aggs)


def fairness(df: DataFrame, specs: dict[str, str | Column], prediction: str) -> DataFrame:
    """``(feature, n_groups, min_rate, max_rate, parity_difference)``."""
    return parity_of_rates(fairness_rates(df, specs, prediction))


def parity_of_rates(rates: DataFrame) -> DataFrame:
    return rates.groupBy("feature").agg(
        F.count("*").alias("n_groups"),
        F.min("rate").alias("min_rate"),
        F.max("rate").alias("max_rate"),
        (F.max("rate") - F.min("rate")).alias("parity_difference"),
    )
