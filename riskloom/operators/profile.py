"""Table profiling (AGG rows). One aggregation for many columns, never a loop of jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from riskloom.functions import safe_divide


def per_column(df: DataFrame, cols: list[str], measures: dict[str, object]) -> DataFrame:
    """One global ``agg`` of every measure on every column, then a row per column.

    ``measures`` maps an output name to a function from column name to Column.
    """
    row = df.agg(*[fn(c).alias(f"{m}__{i}") for i, c in enumerate(cols) for m, fn in measures.items()])
    structs = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{m}__{i}").alias(m) for m in measures])
        for i, c in enumerate(cols)
    ]
    return row.select(F.inline(F.array(*structs)))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def missing_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(feature, n_missing, pct_missing)``."""
    report = per_column(
        df,
        cols or df.columns,
        {"n_missing": lambda c: F.count_if(F.col(c).isNull()), "n_rows": lambda c: F.count("*")},
    )
    pct = safe_divide(F.col("n_missing") * F.lit(100.0), F.col("n_rows"))
    return report.select("feature", "n_missing", pct.alias("pct_missing"))


def digested(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace long text columns by their SHA-256 (32 bytes) for grouping; NULL stays NULL."""
    return df.withColumns({c: F.unhex(F.sha2(F.col(c).cast("binary"), 256)) for c in cols}) if cols else df


def duplicate_rows(df: DataFrame, subset: list[str] | None = None, digest: list[str] = ()) -> DataFrame:
    """Rows that repeat an earlier row. Copies are combined before the shuffle.

    ``digest`` names long text columns that are compared by whole-value SHA-256,
    so the shuffle moves 32 bytes instead of the text.
    """
    cols = subset or df.columns
    groups = digested(df.select(*cols), list(digest)).groupBy(*cols).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts and percentages, largest first; missing values are not counted.

    The total sums the groups: the grouped shuffle is read again, the table is not.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    share = F.col("n") * F.lit(100.0) / total
    return counts.select(col, "n", share.alias("pct")).orderBy(F.desc("n"), F.asc(col))


def distribution_shift(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Class shares in two stages and their absolute difference."""
    from riskloom.operators.joins import compare_counts, tag_snapshots

    both = tag_snapshots(a, b, [col]).where(F.col(col).isNotNull())
    counts = compare_counts(both, [col])
    total_a, total_b = (counts.agg(F.sum(c)).scalar() for c in ("n_ref", "n_cur"))
    shares = counts.select(
        col,
        F.coalesce(safe_divide("n_ref", total_a), F.lit(0.0)).alias("share_a"),
        F.coalesce(safe_divide("n_cur", total_b), F.lit(0.0)).alias("share_b"),
    )
    return shares.withColumn("abs_diff", F.abs(F.col("share_a") - F.col("share_b")))


def describe(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles, max per column."""
    from riskloom.operators.ordered import percentiles

    base = per_column(
        df,
        cols,
        {
            "n": lambda c: F.count(c),
            "mean": lambda c: F.avg(c),
            "std": lambda c: F.stddev_samp(c),
            "min": lambda c: F.min(F.col(c).cast("double")),
            "max": lambda c: F.max(F.col(c).cast("double")),
        },
    )
    quartiles = percentiles(df, cols, [0.25, 0.5, 0.75], approx=approx)
    pick = {0.25: "q1", 0.5: "median", 0.75: "q3"}
    wide = quartiles.groupBy("feature").agg(
        *[F.max(F.when(F.col("p") == F.lit(p), F.col("value"))).alias(name) for p, name in pick.items()]
    )
    return base.join(wide, "feature", "left").select(
        "feature", "n", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def profile(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """min and max of numeric columns, distinct count of any column.

    Distinct values are told apart by their text, which is exact for every atomic type;
    one grouped aggregation over ``(feature, value)`` lets a hot value collapse before
    the shuffle. ``approx=True`` uses one HyperLogLog pass instead.
    """
    numeric = {c for c in cols if isinstance(df.schema[c].dataType, NumericType)}

    def number(c: str) -> Column:
        return F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")

    if approx:
        measures = {"min": lambda c: F.min(number(c)), "max": lambda c: F.max(number(c))}
        return per_column(df, cols, {**measures, "n_unique": lambda c: F.approx_count_distinct(c)})

    def text(c: str) -> Column:
        zero = isinstance(df.schema[c].dataType, (FloatType, DoubleType))
        return (F.col(c) + F.lit(0.0) if zero else F.col(c)).cast("string")  # no second zero

    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), text(c).alias("value"), number(c).alias("number")) for c in cols]
    )
    values = df.select(F.inline(cells)).groupBy("feature", "value").agg(F.first("number").alias("number"))
    return values.groupBy("feature").agg(
        F.min("number").alias("min"), F.max("number").alias("max"), F.count("value").alias("n_unique")
    )


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """Share of the rarest class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg(safe_divide(F.min("n"), F.sum("n")).alias("minority_ratio"))


def group_stats(df: DataFrame, group: str, y: str, digits: int | None = 3) -> DataFrame:
    """Count and mean of ``y`` per group; rows without a group are left out."""
    mean: Column = F.avg(y)
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(y).alias("n"), (mean if digits is None else F.round(mean, digits)).alias("mean"))
    )


def prediction_summary(
    df: DataFrame,
    prediction: str = "prediction",
    p: str = "probability",
    keys: list[str] = (),
    high: float = 0.7,
    inclusive: bool = False,
) -> DataFrame:
    """Totals of a scored table, or per key.

    ``inclusive=False`` counts ``p > high`` as high risk (table scoring),
    ``True`` counts ``p >= high`` (request scoring).
    """
    aggs = summary_measures(prediction, p, high, inclusive)
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def summary_measures(prediction: str, p: str, high: float = 0.7, inclusive: bool = False) -> list[Column]:
    positive = F.col(prediction).cast("int") == 1
    risky = F.col(p) >= high if inclusive else F.col(p) > high
    return [
        F.count("*").alias("total"),
        F.count_if(positive).alias("predicted_positive"),
        F.count_if(~positive).alias("predicted_negative"),
        F.count_if(risky).alias("high_risk"),
        F.avg(p).alias("average_score"),
    ]
