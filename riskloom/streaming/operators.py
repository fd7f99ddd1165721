"""Windowed monitoring (STR-4..7). Every function works on batch and streaming frames alike.

State per window and key is a fixed set of counters: nothing grows with the
number of rows, and a hot key is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import MonitorThresholds
from riskloom.operators.drift import PSI_EPS, equal_width_bin, psi_term, value_ranges
from riskloom.operators.metrics import outcome_counts, ratios
from riskloom.operators.profile import summary_measures


def _windows(df: DataFrame, ts: str, width: str, watermark: str, keys: list[str]):
    return df.withWatermark(ts, watermark).groupBy(F.window(ts, width).alias("window"), *keys)


def _flat(df: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in ("window", *keys)]
    return df.select(F.col("window.start").alias("window_start"), *keys, *rest)


def windowed_summary(
    df: DataFrame,
    ts: str,
    width: str = "6 hours",
    watermark: str = "1 day",
    keys: list[str] = (),
    prediction: str = "prediction",
    p: str = "probability",
    high: float = 0.7,
) -> DataFrame:
    """Prediction summary per tumbling window."""
    agg = _windows(df, ts, width, watermark, keys).agg(*summary_measures(prediction, p, high))
    return _flat(agg, keys)


def windowed_performance(
    df: DataFrame, ts: str, y: str, prediction: str, width: str = "4 hours", watermark: str = "1 day", keys: list[str] = ()
) -> DataFrame:
    """Four counts per window; the ratios are a projection of them."""
    agg = _windows(df, ts, width, watermark, keys).agg(*outcome_counts(y, prediction))
    return _flat(agg.withColumns(ratios()), keys)


def reference_shares(
    ref: DataFrame, cols: list[str], bins: int = 10
) -> dict[str, tuple[tuple[float, float], list[float]]]:
    """Range and bin shares per column: a few numbers that stay fixed while the stream runs.

    The first and the last share are those below and above the range.
    """
    ranges = value_ranges(ref, cols)
    row = ref.agg(
        *[
            F.count_if(equal_width_bin(c, *ranges[c], bins) == b - 1).alias(f"n{i}_{b}")
            for i, c in enumerate(cols)
            for b in range(bins + 2)
        ]
    ).first()
    out = {}
    for i, c in enumerate(cols):
        counts = [row[f"n{i}_{b}"] for b in range(bins + 2)]
        total = sum(counts) or 1
        out[c] = (ranges[c], [n / total for n in counts])
    return out


def windowed_psi(
    df: DataFrame,
    ts: str,
    reference: dict[str, tuple[tuple[float, float], list[float]]],
    width: str = "4 hours",
    watermark: str = "1 day",
    keys: list[str] = (),
    eps: float = PSI_EPS,
) -> DataFrame:
    """PSI per window and column against fixed reference shares.

    The bins are conditional counts of one aggregation, so a stream needs
    neither a second stateful aggregation nor a join with the reference.
    """
    counts: list[Column] = []
    for i, (c, ((lo, hi), shares)) in enumerate(reference.items()):
        where = equal_width_bin(c, lo, hi, len(shares) - 2)
        counts += [F.count_if(where == b - 1).alias(f"n{i}_{b}") for b in range(len(shares))]
    agg = _windows(df, ts, width, watermark, keys).agg(*counts)
    scores = []
    for i, (c, (_, shares)) in enumerate(reference.items()):
        total = sum((F.col(f"n{i}_{b}") for b in range(1, len(shares))), F.col(f"n{i}_0"))
        terms = [
            psi_term(F.lit(float(r)), F.coalesce(F.try_divide(F.col(f"n{i}_{b}"), total), F.lit(0.0)), eps)
            for b, r in enumerate(shares)
        ]
        scores.append(sum(terms[1:], terms[0]).alias(f"psi_{c}"))
    return _flat(agg.select("window", *keys, *scores), keys)


def alert_stream(
    windows: DataFrame, thresholds: MonitorThresholds = MonitorThresholds(), psi_threshold: float = 0.2
) -> DataFrame:
    """Every window with its status and messages; a projection, so a window that recovers says so.

    Uses whichever numbers the windows carry: ``accuracy`` below its limit is
    critical, a share of drifted ``psi_*`` columns above its limit is an alert, all else is
    healthy. ``active_alerts`` picks the windows that need attention when the table is read.
    """
    no = F.lit(False)
    scores = [c for c in windows.columns if c.startswith("psi_")]
    drifted = no
    if scores:
        flags = [(F.col(c) >= F.lit(psi_threshold)).cast("int") for c in scores]
        drifted = sum(flags[1:], flags[0]) / F.lit(len(scores)) > F.lit(thresholds.drift)
    weak = F.col("accuracy") < F.lit(thresholds.accuracy) if "accuracy" in windows.columns else no
    drifted, weak = F.coalesce(drifted, no), F.coalesce(weak, no)
    messages = [
        F.when(drifted, F.lit("Data drift detected")),
        F.when(weak, F.lit("Model performance below threshold")),
    ]
    return windows.withColumns(
        {
            "monitoring_status": F.when(weak, F.lit("critical")).when(drifted, F.lit("alert")).otherwise(F.lit("healthy")),
            "alerts": F.array_compact(F.array(*messages)),
        }
    )


def active_alerts(windows: DataFrame) -> DataFrame:
    """Windows whose latest status is not healthy."""
    return windows.where(F.col("monitoring_status") != "healthy")
