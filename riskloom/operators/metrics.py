"""Classification metrics (MET rows). All but AUC are arithmetic over four counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import DEPLOY_MINIMUMS
from riskloom.functions import safe_divide
from riskloom.operators.joins import compare_counts, tag_snapshots
from riskloom.operators.ordered import ROWS_PER_BUCKET, ranked_values

METRIC_NAMES = ("accuracy", "precision", "recall", "f1_score")


def outcome_counts(y: str, prediction: str) -> list[Column]:
    """The four conditional counts; rows without a label or prediction count nowhere."""
    actual, predicted = F.col(y).cast("int") == 1, F.col(prediction).cast("int") == 1
    return [
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    ]


def ratios() -> dict[str, Column]:
    """Metrics from tp/fp/fn/tn columns; 0 where a ratio has an empty denominator."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def rate(a: Column, b: Column) -> Column:
        return F.coalesce(safe_divide(a, b), F.lit(0.0))

    return {
        "accuracy": safe_divide(tp + tn, tp + fp + fn + tn),
        "precision": rate(tp, tp + fp),
        "recall": rate(tp, tp + fn),
        "f1_score": rate(F.lit(2) * tp, F.lit(2) * tp + fp + fn),
    }


def binary_metrics(df: DataFrame, y: str, prediction: str, keys: list[str] = ()) -> DataFrame:
    """tp, fp, fn, tn and the four ratios, for the table or per key."""
    counts = df.groupBy(*keys).agg(*outcome_counts(y, prediction)) if keys else df.agg(*outcome_counts(y, prediction))
    return counts.withColumns(ratios())


def roc_auc(df: DataFrame, y: str, score: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Area under the ROC curve with ties counted half; NULL when a class is absent."""
    label = F.col(y).cast("int")
    flags = {"pos": F.coalesce((label == 1).cast("int"), F.lit(0)), "neg": F.coalesce((label == 0).cast("int"), F.lit(0))}
    ranked = ranked_values(df, [score], flags, rows_per_bucket)
    pairs = F.col("pos").cast("double") * (F.col("before_neg") + F.col("neg") / F.lit(2.0))
    possible = F.max("total_pos").cast("double") * F.max("total_neg").cast("double")
    return ranked.agg(safe_divide(F.sum(pairs), possible).alias("roc_auc"))


def confusion(df: DataFrame, y: str, prediction: str, classes: list = (0, 1)) -> DataFrame:
    """``(actual, predicted, n)`` for every pair of the declared classes and those found in the data.

    Rows without a label or prediction count nowhere.
    """
    pairs = (
        df.where(F.col(y).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(F.col(y).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted"))
        .agg(F.count("*").alias("n"))
    )
    declared = F.array(*[F.lit(c) for c in classes]).cast("array<int>")
    found = F.concat(F.collect_set("actual"), F.collect_set("predicted"), declared)
    names = pairs.agg(F.array_distinct(found).alias("classes"))
    cells = names.select(F.explode("classes").alias("actual"), "classes")
    cells = cells.select("actual", F.explode("classes").alias("predicted"))
    return cells.join(pairs, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def by_class(df: DataFrame, y: str, prediction: str) -> DataFrame:
    """precision, recall, F1 and support of every class.

    Row and column totals come from stacking each counted pair under its actual
    and its predicted class, so no join is needed.
    """
    pairs = (
        df.where(F.col(y).isNotNull() & F.col(prediction).isNotNull())
        .select(F.col(y).cast("int").alias("a"), F.col(prediction).cast("int").alias("p"))
        .groupBy("a", "p")
        .agg(F.count("*").alias("n"))
    )
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(zero)
    stacked = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("a").alias("class"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("hits")
                ),
                F.struct(
                    F.col("p").alias("class"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("hits")
                ),
            )
        )
    )
    totals = stacked.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    none = F.lit(0.0)
    return totals.select(
        "class",
        "support",
        F.coalesce(safe_divide("hits", "predicted"), none).alias("precision"),
        F.coalesce(safe_divide("hits", "support"), none).alias("recall"),
        F.coalesce(safe_divide(F.lit(2) * F.col("hits"), F.col("predicted") + F.col("support")), none).alias("f1"),
    )


def class_balance(ref: DataFrame, cur: DataFrame, y: str) -> DataFrame:
    """Share of every class in both snapshots."""
    both = tag_snapshots(ref, cur, [y]).where(F.col(y).isNotNull())
    counts = compare_counts(both, [y])
    n_ref, n_cur = (counts.agg(F.sum(c)).scalar() for c in ("n_ref", "n_cur"))
    return counts.select(
        F.col(y).alias("class"),
        "n_ref",
        "n_cur",
        F.coalesce(safe_divide("n_ref", n_ref), F.lit(0.0)).alias("share_ref"),
        F.coalesce(safe_divide("n_cur", n_cur), F.lit(0.0)).alias("share_cur"),
    )


def performance(df: DataFrame, y: str, prediction: str, score: str | None = None) -> DataFrame:
    """One row: counts, the four ratios and ROC AUC (of the score, or of the prediction without one)."""
    auc = roc_auc(df, y, score or prediction)
    return binary_metrics(df, y, prediction).withColumn("roc_auc", auc.scalar())


def performance_report(
    cur: DataFrame, y: str, prediction: str, score: str | None = None, ref: DataFrame | None = None
) -> DataFrame:
    """Long form ``(section, name, value)``: quality, confusion, per class, class balance."""

    def rows(df: DataFrame, section: str, prefix, cols: list[str]) -> DataFrame:
        cells = [
            F.struct(F.concat(prefix, F.lit(c)).alias("name"), F.col(c).cast("double").alias("value")) for c in cols
        ]
        return df.select(F.lit(section).alias("section"), F.inline(F.array(*cells)))

    parts = [
        rows(performance(cur, y, prediction, score), "quality", F.lit(""), [*METRIC_NAMES, "roc_auc"]),
        rows(
            confusion(cur, y, prediction),
            "confusion",
            F.concat(F.lit("actual_"), F.col("actual"), F.lit("_predicted_"), F.col("predicted"), F.lit("_")),
            ["n"],
        ),
        rows(
            by_class(cur, y, prediction),
            "by_class",
            F.concat(F.lit("class_"), F.col("class"), F.lit("_")),
            ["precision", "recall", "f1"],
        ),
    ]
    if ref is not None and y in ref.columns:
        balance = class_balance(ref, cur, y)
        prefix = F.concat(F.lit("class_"), F.col("class").cast("string"), F.lit("_"))
        parts.append(rows(balance, "class_balance", prefix, ["share_ref", "share_cur"]))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def gate(metrics: DataFrame, minimums: dict[str, float] = DEPLOY_MINIMUMS) -> DataFrame:
    """Add ``passed`` and the ``failures`` list; a missing metric fails."""
    failed = [
        F.when(F.coalesce(F.col(m) < F.lit(float(low)), F.lit(True)), F.lit(m)) for m, low in minimums.items()
    ]
    return metrics.withColumn("failures", F.array_compact(F.array(*failed))).withColumn(
        "passed", F.size("failures") == 0
    )


def pick_best(results: DataFrame, f1: str = "f1_score", position: str = "position", keys: list[str] = ()) -> DataFrame:
    """Row with the strictly greatest F1, the first one on a tie, none if all are 0.

    An aggregate with map-side combine, not a window: one winner per key however
    many runs a key has.
    """
    order = F.struct(F.col(f1), -F.col(position))
    row = F.struct(*[F.col(c) for c in results.columns])
    alive = results.where(F.col(f1) > 0)
    best = alive.groupBy(*keys).agg(F.max_by(row, order).alias("best"))
    return best.where(F.col("best").isNotNull()).select("best.*")


def comparison(results: DataFrame, metrics: list[str] = ("accuracy", "f1_score", "roc_auc")) -> DataFrame:
    """Model table, best F1 first."""
    return results.select("model", *metrics).orderBy(F.desc("f1_score"), F.asc("model"))
