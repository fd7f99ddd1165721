"""Running sums and exact percentiles in value order, without a one-task sort.

Everything that needs "how many values lie below this one" (ROC AUC,
Kolmogorov-Smirnov, Wasserstein, Spearman ranks, exact quantiles) goes through
this module:

1. value range cut into buckets of bounded size (cut points from a small
   sample; they only balance the work, any cut points give the same result);
2. rows combined per ``(feature, bucket, value)`` before any ordering, so a
   value that holds a third of all rows becomes one row;
3. a window inside each bucket, plus the total of the earlier buckets.

The cut points are fixed numbers in the plan, so a re-executed task puts every
value into the same bucket as before.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROWS_PER_BUCKET = 100_000
SELECT_BUCKETS = 128
_SAMPLE_PER_BUCKET = 200
#: Ranks above which these are looked up by joins; a condition for each in one expression is too long to be compiled.
MANY_RANKS = 64


def bucket_cuts(
    df: DataFrame,
    cols: list[str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    n: int | None = None,
) -> dict[str, list[float]]:
    """Inner cut points per column; an empty list means one bucket is enough.

    ``n`` is the row count when the caller already knows it.
    """
    n = df.count() if n is None else n
    buckets = math.ceil(n / rows_per_bucket)
    if buckets <= 1:
        return {c: [] for c in cols}
    fraction = min(1.0, _SAMPLE_PER_BUCKET * buckets / n)
    sampled = df if fraction == 1.0 else df.sample(fraction, seed=7)
    grid = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    accuracy = F.lit(min(1_000_000, 20 * buckets))
    row = sampled.agg(
        *[F.percentile_approx(F.col(c).cast("double"), grid, accuracy).alias(f"q{i}") for i, c in enumerate(cols)]
    ).first()
    return {
        c: sorted({float(v) for v in (row[f"q{i}"] or []) if v is not None and math.isfinite(v)})
        for i, c in enumerate(cols)
    }


def _listed_bucket(value: Column, cuts: list[float], buckets: list[int]) -> Column:
    """Number of the listed bucket that holds the value, else NULL; plain comparisons for a few buckets."""
    chain = F.when(F.lit(False), F.lit(0))
    for b in buckets:
        inside = value.isNotNull() if b == 0 else value >= F.lit(cuts[b - 1])
        chain = chain.when(inside & (value < F.lit(cuts[b])) if b < len(cuts) else inside, F.lit(b))
    return chain


def long_values(
    df: DataFrame,
    cols: list[str],
    cuts: dict[str, list[float]],
    extra: list[str] = (),
    only: dict[str, list[int]] | None = None,
) -> DataFrame:
    """``(extra…, feature, bucket, value)`` rows of the non-missing values.

    ``only`` keeps the listed buckets per column.
    """
    base = df.select(*extra, *[F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(cols)])
    split = [i for i, c in enumerate(cols) if cuts.get(c)]
    if split and only is None:
        base = Bucketizer(
            splitsArray=[[-math.inf, *cuts[cols[i]], math.inf] for i in split],
            inputCols=[f"__v{i}" for i in split],
            outputCols=[f"__b{i}" for i in split],
            handleInvalid="keep",
        ).transform(base)
    cells = []
    for i, c in enumerate(cols):
        value = F.col(f"__v{i}")
        if only is not None:
            bucket = _listed_bucket(value, cuts.get(c, []), only[c])
            value = F.when(bucket.isNotNull(), value)
        else:
            bucket = F.col(f"__b{i}").cast("int") if i in split else F.lit(0)
        cells.append(F.struct(F.lit(c).alias("feature"), bucket.alias("bucket"), value.alias("value")))
    long = base.select(*extra, F.inline(F.array(*cells)))
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def counted_values(
    df: DataFrame,
    cols: list[str],
    measures: dict[str, Column | str],
    cuts: dict[str, list[float]] | None = None,
) -> DataFrame:
    """One row per distinct ``(feature, value)`` with the summed measures."""
    cuts = bucket_cuts(df, cols) if cuts is None else cuts
    named = df.select(
        *cols, *[(F.col(m) if isinstance(m, str) else m).cast("bigint").alias(f"__m_{k}") for k, m in measures.items()]
    )
    long = long_values(named, cols, cuts, [f"__m_{k}" for k in measures])
    return long.groupBy("feature", "bucket", "value").agg(*[F.sum(f"__m_{k}").alias(k) for k in measures])


def running_totals(counted: DataFrame, measures: list[str], bucketed: bool) -> DataFrame:
    """Add ``before_<measure>`` (sum over smaller values) and ``next_value``."""
    here = Window.partitionBy("feature", "bucket").orderBy("value")
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = counted.withColumns(
        {
            **{f"before_{m}": F.sum(m).over(upto) - F.col(m) for m in measures},
            "next_value": F.lead("value").over(here),
        }
    )
    if not bucketed:
        return inside
    # One row per column and bucket, a bucket being ROWS_PER_BUCKET rows.
    totals = counted.groupBy("feature", "bucket").agg(
        *[F.sum(m).alias(f"__t_{m}") for m in measures], F.min("value").alias("__first")
    )
    across = Window.partitionBy("feature").orderBy("bucket")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "feature",
        "bucket",
        *[F.coalesce(F.sum(f"__t_{m}").over(earlier), F.lit(0)).alias(f"__o_{m}") for m in measures],
        F.lead("__first").over(across).alias("__next"),
    )
    joined = inside.join(F.broadcast(offsets), ["feature", "bucket"])
    return joined.select(
        *counted.columns,
        *[(F.col(f"before_{m}") + F.col(f"__o_{m}")).alias(f"before_{m}") for m in measures],
        F.coalesce("next_value", "__next").alias("next_value"),
    )


def feature_totals(counted: DataFrame, measures: list[str]) -> DataFrame:
    """One row per column: the number of columns bounds its size."""
    return counted.groupBy("feature").agg(*[F.sum(m).alias(f"total_{m}") for m in measures])


def ranked_values(
    df: DataFrame,
    cols: list[str],
    measures: dict[str, Column | str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    totals: bool = True,
    n: int | None = None,
) -> DataFrame:
    """Distinct values with measures, sums before them, the next value, and (optionally) totals."""
    cuts = bucket_cuts(df, cols, rows_per_bucket, n=n)
    counted = counted_values(df, cols, measures, cuts)
    names = list(measures)
    running = running_totals(counted, names, any(cuts.values()))
    return running.join(F.broadcast(feature_totals(counted, names)), "feature") if totals else running


# --- percentiles ---------------------------------------------------------------


def order_statistics(
    df: DataFrame, cols: list[str], wanted_ranks: Callable[[int], set[int]], n: int
) -> tuple[dict[str, dict[int, float]], dict[str, int]]:
    """Exact values at given ranks, by selection: (value per rank, non-missing count) per column.

    ``wanted_ranks`` maps a column's non-missing count to 0-based ranks. Two
    passes over the columns and, for large tables, one small sample: count per
    bucket, then order only the buckets that hold a wanted rank (a few out of at
    least ``SELECT_BUCKETS``). The driver sees bucket counts and the wanted
    values, never rows.
    """
    per_bucket = n if n <= ROWS_PER_BUCKET else min(ROWS_PER_BUCKET, n // SELECT_BUCKETS)
    cuts = bucket_cuts(df, cols, max(per_bucket, 1), n=n)
    sizes: dict[str, list[tuple[int, int]]] = {c: [] for c in cols}
    for r in long_values(df, cols, cuts).groupBy("feature", "bucket").count().collect():
        sizes[r["feature"]].append((r["bucket"], r["count"]))
    present = {c: sum(k for _, k in sizes[c]) for c in cols}
    wanted = []
    for c in cols:
        ranks, start = wanted_ranks(present[c]) if present[c] else set(), 0
        for bucket, k in sorted(sizes[c]):
            wanted += [(c, bucket, start, r) for r in ranks if start <= r < start + k]
            start += k
    found: dict[str, dict[int, float]] = {c: {} for c in cols}
    if not wanted:
        return found, present
    hits = {c: sorted({b for f, b, *_ in wanted if f == c}) for c in cols}
    many = len(wanted) > MANY_RANKS
    if many:
        listed = reduce(lambda x, y: x | y, [(F.col("feature") == c) & F.col("bucket").isin(hits[c]) for c in cols if hits[c]])
        inside = long_values(df, cols, cuts).where(listed)
    else:
        inside = long_values(df, cols, cuts, only=hits)
    counts = inside.groupBy("feature", "bucket", "value").agg(F.count("*").alias("n"))
    order = Window.partitionBy("feature", "bucket").orderBy("value")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if many:
        places = df.sparkSession.createDataFrame(wanted, "feature string, bucket int, start bigint, rank bigint")
        offset = F.col("rank") - F.col("start")
        here = (F.col("upto") > offset) & (F.col("upto") - F.col("n") <= offset)
        # a row a wanted rank
        for row in counts.withColumn("upto", upto).join(F.broadcast(places), ["feature", "bucket"]).where(here).collect():
            found[row["feature"]][row["rank"]] = row["value"]
        return found, present
    here = lambda c, b, offset: (
        (F.col("feature") == c) & (F.col("bucket") == b) & (F.col("upto") > offset) & (F.col("upto") - F.col("n") <= offset)
    )
    covers = reduce(lambda x, y: x | y, [here(c, b, r - start) for c, b, start, r in wanted])
    for row in counts.withColumn("upto", upto).where(covers).collect():
        for c, b, start, r in wanted:
            if (c, b) == (row["feature"], row["bucket"]) and row["upto"] - row["n"] <= r - start < row["upto"]:
                found[c][r] = row["value"]
    return found, present


def ranks_around(position: float) -> set[int]:
    return {math.floor(position), math.ceil(position)}


def interpolated(values: dict[int, float], position: float) -> float:
    lo, hi = math.floor(position), math.ceil(position)
    return values[lo] + (values[hi] - values[lo]) * (position - lo)


def _selected(df: DataFrame, cols: list[str], ps: list[float], n: int) -> dict[str, list]:
    found, present = order_statistics(
        df, cols, lambda k: set().union(*[ranks_around(p * (k - 1)) for p in ps]), n
    )
    return {
        c: [interpolated(found[c], p * (present[c] - 1)) for p in ps] if present[c] else [None] * len(ps) for c in cols
    }


def _sketched(df: DataFrame, cols: list[str], ps: list[float]) -> dict[str, list]:
    grid = F.array(*[F.lit(p) for p in ps])
    numbers = [F.col(c).cast("double") for c in cols]
    quantiles = [F.percentile_approx(F.when(~F.isnan(x), x), grid, F.lit(10_000)) for x in numbers]
    row = df.agg(*[q.alias(f"q{i}") for i, q in enumerate(quantiles)]).first()
    return {c: list(row[f"q{i}"] or [None] * len(ps)) for i, c in enumerate(cols)}


def percentile_values(
    df: DataFrame, cols: list[str], ps: list[float], approx: bool = False, n: int | None = None
) -> dict[str, list]:
    """Linearly interpolated percentiles as driver numbers (columns x percentiles of them).

    Exact by bucket selection at every size; the built-in exact aggregate would keep
    every distinct value in one task. ``approx=True`` is one sketch pass. NaN is no value.
    """
    cols, ps = list(cols), [float(p) for p in ps]
    if approx:
        return _sketched(df, cols, ps)
    return _selected(df, cols, ps, df.count() if n is None else n)


def percentiles(df: DataFrame, cols: list[str], ps: list[float], approx: bool = False) -> DataFrame:
    """``(feature, p, value)`` rows."""
    values = percentile_values(df, cols, ps, approx)
    rows = [(c, float(p), v) for c, vs in values.items() for p, v in zip(ps, vs)]
    return df.sparkSession.createDataFrame(rows, "feature string, p double, value double")
