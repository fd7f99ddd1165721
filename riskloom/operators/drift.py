"""Drift between a reference and a current snapshot (DRF rows) and conflicts (CON rows).

Definitions the reference behaviour leaves to a library are fixed here:

* PSI: equal-width bins over the reference range and one bin on either side of it,
  shares floored at ``eps``. A constant reference has one bin and its two neighbours.
* KS p-value: the asymptotic series with the usual small-sample correction.
* Wasserstein: first-order distance divided by the reference standard deviation.
* Jensen-Shannon: natural-log divergence; the distance is ``sqrt(js / ln 2)``.
* chi-square: two-sample statistic over the 2 x k table of counts.
* Default methods, at every size: Wasserstein (numeric) and Jensen-Shannon
  distance (categorical) at 0.1.
* Damaged columns: without values on both sides there is no score (NULL). A column
  with values on one side only, of another type, or absent from a snapshot has
  drifted; one without values on either side has not. NaN is no value.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from riskloom.functions import safe_divide
from riskloom.functions.special import chi2_tail as _chi2_tail
from riskloom.functions.special import normal_two_sided as _normal_two_sided
from riskloom.operators.joins import compare_counts, tag_snapshots
from riskloom.operators.ordered import ROWS_PER_BUCKET, ranked_values
from riskloom.operators.profile import digested, per_column

PSI_BINS = 10
PSI_EPS = 1e-4
THRESHOLDS = {"psi": 0.2, "psi_cat": 0.2, "ks": 0.05, "wasserstein": 0.1, "js": 0.1, "chi2": 0.05, "z": 0.05}
P_VALUE_METHODS = ("ks", "chi2", "z")
DATASET_SHARE = 0.5


def _number(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def value_ranges(ref: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Reference minimum and maximum: two numbers per column, one aggregation."""
    row = ref.agg(
        *[f(_number(c)).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}


def equal_width_bin(c: str, lo: float | None, hi: float | None, bins: int) -> Column:
    """0-based bin of a value inside the reference range, -1 below it, ``bins`` above it; NULL stays NULL."""
    x = _number(c)
    if lo is None or hi is None:
        return F.when(x.isNotNull(), F.lit(0))
    inside = F.lit(0)
    if hi > lo:
        inside = F.least(F.floor((x - F.lit(lo)) / F.lit((hi - lo) / bins)), F.lit(bins - 1))
    return F.when(x < F.lit(lo), F.lit(-1)).when(x > F.lit(hi), F.lit(bins)).when(x.isNotNull(), inside).cast("int")


def compare_hist(
    ref: DataFrame, cur: DataFrame, cols: list[str], bins: int = PSI_BINS, ranges: dict | None = None
) -> DataFrame:
    """``(feature, bin, n_ref, n_cur)`` for all columns in one aggregation."""
    ranges = ranges or value_ranges(ref, cols)
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), equal_width_bin(c, *ranges[c], bins).alias("bin")) for c in cols]
    )
    long = tag_snapshots(ref, cur, cols).select("is_ref", F.inline(cells)).where(F.col("bin").isNotNull())
    return compare_counts(long, ["feature", "bin"])


def compare_categories(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """``(feature, category, n_ref, n_cur)`` for all columns in one aggregation."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in cols]
    )
    long = tag_snapshots(ref, cur, cols).select("is_ref", F.inline(cells)).where(F.col("category").isNotNull())
    return compare_counts(long, ["feature", "category"])


def with_shares(hist: DataFrame) -> DataFrame:
    """Add totals and shares. The totals frame has one row per column, which bounds the broadcast."""
    totals = hist.groupBy("feature").agg(F.sum("n_ref").alias("total_ref"), F.sum("n_cur").alias("total_cur"))
    return hist.join(F.broadcast(totals), "feature").withColumns(
        {"r": safe_divide("n_ref", "total_ref"), "c": safe_divide("n_cur", "total_cur")}
    )


def psi_term(r: Column, c: Column, eps: float = PSI_EPS) -> Column:
    r, c = F.greatest(r, F.lit(eps)), F.greatest(c, F.lit(eps))
    return (c - r) * F.log(c / r)


def _if_both(score: Column, n_ref: str = "total_ref", n_cur: str = "total_cur") -> Column:
    """An aggregate that is NULL unless both sides have values."""
    return F.when((F.max(n_ref) > 0) & (F.max(n_cur) > 0), score)


def psi_of(hist: DataFrame, eps: float = PSI_EPS) -> DataFrame:
    score = _if_both(F.sum(psi_term(F.col("r"), F.col("c"), eps)))
    return with_shares(hist).groupBy("feature").agg(score.alias("psi"))


def psi(ref, cur, cols: list[str], bins: int = PSI_BINS, eps: float = PSI_EPS, ranges: dict | None = None) -> DataFrame:
    """``(feature, psi)`` of numeric columns."""
    return psi_of(compare_hist(ref, cur, cols, bins, ranges), eps)


def psi_cat(ref: DataFrame, cur: DataFrame, cols: list[str], eps: float = PSI_EPS) -> DataFrame:
    """``(feature, psi)`` of categorical columns."""
    return psi_of(compare_categories(ref, cur, cols), eps)


def js_divergence(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """``(feature, js_divergence, js_distance)`` of categorical columns."""
    r, c = F.col("r"), F.col("c")
    m = (r + c) / F.lit(2.0)

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log(x / m)).otherwise(F.lit(0.0))

    div = F.sum((part(r) + part(c)) / F.lit(2.0))
    out = with_shares(compare_categories(ref, cur, cols)).groupBy("feature").agg(_if_both(div).alias("js_divergence"))
    positive = F.when(F.col("js_divergence") > 0, F.col("js_divergence")).otherwise(F.col("js_divergence") * F.lit(0.0))
    return out.withColumn("js_distance", F.sqrt(positive / F.lit(math.log(2))))


def _two_samples(ref: DataFrame, cur: DataFrame, cols: list[str], rows_per_bucket: int) -> DataFrame:
    measures = {"ref": F.col("is_ref"), "cur": F.lit(1) - F.col("is_ref")}
    return ranked_values(tag_snapshots(ref, cur, cols), cols, measures, rows_per_bucket)


def _cdf_gap() -> Column:
    upto_ref = safe_divide(F.col("before_ref") + F.col("ref"), F.col("total_ref"))
    upto_cur = safe_divide(F.col("before_cur") + F.col("cur"), F.col("total_cur"))
    return F.abs(upto_ref - upto_cur)


def ks_p_value(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample series, 100 terms; NULL without a distance."""
    root = F.sqrt(safe_divide(n * m, n + m))
    lam = (root + F.lit(0.12) + safe_divide(F.lit(0.11), root)) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    return F.when(lam < 0.2, F.lit(1.0)).when(lam.isNotNull(), F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def ks(ref: DataFrame, cur: DataFrame, cols: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``(feature, ks, p_value)``: largest distance between the two distribution functions."""
    stats = (
        _two_samples(ref, cur, cols, rows_per_bucket)
        .groupBy("feature")
        .agg(
            F.max(_cdf_gap()).alias("ks"),
            F.max("total_ref").cast("double").alias("n"),
            F.max("total_cur").cast("double").alias("m"),
        )
    )
    return stats.select("feature", "ks", ks_p_value(F.col("ks"), F.col("n"), F.col("m")).alias("p_value"))


def wasserstein(
    ref: DataFrame, cur: DataFrame, cols: list[str], normed: bool = True, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """``(feature, wasserstein)``; ``normed`` divides by the reference standard deviation."""
    step = _cdf_gap() * (F.col("next_value") - F.col("value"))
    area = (
        _two_samples(ref, cur, cols, rows_per_bucket)
        .groupBy("feature")
        .agg(_if_both(F.coalesce(F.sum(step), F.lit(0.0))).alias("wasserstein"))
    )
    if not normed:
        return area
    spread = per_column(ref, cols, {"std": lambda c: F.stddev_pop(F.col(c).cast("double"))})
    scale = F.when(F.col("std") > 0, F.col("std")).otherwise(F.lit(1.0))
    joined = area.join(F.broadcast(spread), "feature")  # one row per column
    return joined.select("feature", (F.col("wasserstein") / scale).alias("wasserstein"))


def chi2_stat(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """``(feature, chi2, dof)``: two-sample chi-square over the category counts."""
    shares = with_shares(compare_categories(ref, cur, cols))
    pooled = safe_divide(F.col("n_ref") + F.col("n_cur"), F.col("total_ref") + F.col("total_cur"))
    terms = []
    for n, total in (("n_ref", "total_ref"), ("n_cur", "total_cur")):
        expected = pooled * F.col(total)
        terms.append(F.coalesce(safe_divide((F.col(n) - expected) * (F.col(n) - expected), expected), F.lit(0.0)))
    return shares.groupBy("feature").agg(
        _if_both(F.sum(terms[0] + terms[1])).alias("chi2"), (F.count("*") - 1).alias("dof")
    )


def chi2(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    return chi2_stat(ref, cur, cols).withColumn("p_value", _chi2_tail(F.col("chi2"), F.col("dof")))


def prop_z(ref: DataFrame, cur: DataFrame, tests: dict[str, Column | str]) -> DataFrame:
    """``(feature, z)`` of two proportions, pooled; ``tests`` maps a name to a boolean expression."""
    flags = {k: (F.col(v) if isinstance(v, str) else v).cast("int") for k, v in tests.items()}
    both = tag_snapshots(
        ref.select(*[f.alias(k) for k, f in flags.items()]), cur.select(*[f.alias(k) for k, f in flags.items()]), list(flags)
    )
    is_ref = F.col("is_ref") == 1
    stats = per_column(
        both,
        list(flags),
        {
            "x1": lambda c: F.sum(F.when(is_ref, F.col(c))),
            "n1": lambda c: F.count(F.when(is_ref, F.col(c))),
            "x2": lambda c: F.sum(F.when(~is_ref, F.col(c))),
            "n2": lambda c: F.count(F.when(~is_ref, F.col(c))),
        },
    )
    p1, p2 = safe_divide("x1", "n1"), safe_divide("x2", "n2")
    pooled = safe_divide(F.col("x1") + F.col("x2"), F.col("n1") + F.col("n2"))
    spread = F.sqrt(pooled * (1 - pooled) * (safe_divide(F.lit(1), F.col("n1")) + safe_divide(F.lit(1), F.col("n2"))))
    measured = (F.col("n1") > 0) & (F.col("n2") > 0)
    return stats.select("feature", F.when(measured, F.coalesce(safe_divide(p2 - p1, spread), F.lit(0.0))).alias("z"))


def z_test(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """Two-sided p-value for 0/1 columns."""
    tests = {c: F.col(c).cast("int") == 1 for c in cols}
    return prop_z(ref, cur, tests).withColumn("p_value", _normal_two_sided(F.col("z")))


_SCORES = {
    "psi": (lambda r, c, cols, bins: psi(r, c, cols, bins), "psi"),
    "psi_cat": (lambda r, c, cols, bins: psi_cat(r, c, cols), "psi"),
    "ks": (lambda r, c, cols, bins: ks(r, c, cols), "p_value"),
    "wasserstein": (lambda r, c, cols, bins: wasserstein(r, c, cols), "wasserstein"),
    "js": (lambda r, c, cols, bins: js_divergence(r, c, cols), "js_distance"),
    "chi2": (lambda r, c, cols, bins: chi2(r, c, cols), "p_value"),
    "z": (lambda r, c, cols, bins: z_test(r, c, cols), "p_value"),
}


def choose_methods(numeric: list[str], categorical: list[str] = ()) -> dict[str, str]:
    """Default method per column, the same for tables of every size."""
    return {**{c: "wasserstein" for c in numeric}, **{c: "js" for c in categorical}}


def comparable(ref: DataFrame, cur: DataFrame, c: str) -> bool:
    """Both snapshots have the column and their types can be united: both numeric, or equal."""
    if c not in ref.columns or c not in cur.columns:
        return False
    a, b = ref.schema[c].dataType, cur.schema[c].dataType
    return a == b or (isinstance(a, NumericType) and isinstance(b, NumericType))


def _filled(df: DataFrame, cols: list[str]) -> dict[str, int]:
    """Values per column."""
    floating = (FloatType, DoubleType)
    known = [_number(c) if isinstance(df.schema[c].dataType, floating) else F.col(c) for c in cols]
    return dict(zip(cols, df.agg(*[F.count(x).alias(f"n{i}") for i, x in enumerate(known)]).first())) if cols else {}


def column_status(ref: DataFrame, cur: DataFrame, cols: list[str]) -> dict[str, str]:
    """``ok``, ``no_reference``, ``no_current``, ``no_data``, ``type_changed`` or ``missing_column`` per column."""
    usable = [c for c in cols if comparable(ref, cur, c)]
    n_ref, n_cur = _filled(ref, usable), _filled(cur, usable)
    out = {}
    for c in cols:
        if c not in usable:
            out[c] = "type_changed" if c in ref.columns and c in cur.columns else "missing_column"
        elif n_ref[c] and n_cur[c]:
            out[c] = "ok"
        else:
            out[c] = "no_current" if n_ref[c] else "no_reference" if n_cur[c] else "no_data"
    return out


def column_drift(
    ref: DataFrame, cur: DataFrame, methods: dict[str, str], thresholds: dict | None = None, bins: int = PSI_BINS
) -> DataFrame:
    """``(feature, method, score, threshold, drifted, status)`` of every asked column; one job per method.

    Only columns with values on both sides are scored; see the module header for the others.
    """
    limits = {**THRESHOLDS, **(thresholds or {})}
    status = column_status(ref, cur, list(methods))
    rows = [(c, m, float(limits[m]), status[c]) for c, m in methods.items()]
    asked = ref.sparkSession.createDataFrame(rows, "feature string, method string, threshold double, status string")
    parts = []
    for method in dict.fromkeys(methods.values()):
        cols = [c for c, m in methods.items() if m == method and status[c] == "ok"]
        if cols:
            compute, column = _SCORES[method]
            parts.append(compute(ref, cur, cols, bins).select("feature", F.col(column).cast("double").alias("score")))
    if parts:
        joined = asked.join(F.broadcast(reduce(DataFrame.unionByName, parts)), "feature", "left")  # one row per column
    else:
        joined = asked.withColumn("score", F.lit(None).cast("double"))
    small = F.col("method").isin(*P_VALUE_METHODS)
    crossed = F.when(small, F.col("score") < F.col("threshold")).otherwise(F.col("score") >= F.col("threshold"))
    drifted = F.when(F.col("status") == "ok", F.coalesce(crossed, F.lit(False))).otherwise(F.col("status") != "no_data")
    return joined.select("feature", "method", "score", "threshold", drifted.alias("drifted"), "status")


def drift_summary(columns: DataFrame, share: float = DATASET_SHARE) -> DataFrame:
    """Measured share of drifted columns and the verdict."""
    out = columns.agg(
        F.count("*").alias("n_columns"),
        F.count_if("drifted").alias("n_drifted"),
        F.avg(F.col("drifted").cast("double")).alias("drift_share"),
    )
    return out.withColumn("dataset_drift", F.coalesce(F.col("drift_share") >= share, F.lit(False)))


def dataset_drift(
    ref: DataFrame,
    cur: DataFrame,
    methods: dict[str, str],
    thresholds: dict | None = None,
    share: float = DATASET_SHARE,
) -> DataFrame:
    return drift_summary(column_drift(ref, cur, methods, thresholds), share)


def missing_compare(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """Missing counts and shares of both snapshots, one aggregation."""
    is_ref = F.col("is_ref") == 1
    stats = per_column(
        tag_snapshots(ref, cur, cols),
        cols,
        {
            "missing_ref": lambda c: F.count_if(is_ref & F.col(c).isNull()),
            "missing_cur": lambda c: F.count_if(~is_ref & F.col(c).isNull()),
            "n_ref": lambda c: F.count_if(is_ref),
            "n_cur": lambda c: F.count_if(~is_ref),
        },
    )
    return stats.select(
        "feature",
        "missing_ref",
        "missing_cur",
        safe_divide("missing_ref", "n_ref").alias("share_ref"),
        safe_divide("missing_cur", "n_cur").alias("share_cur"),
    )


def _pearson(df: DataFrame, cols: list[str]) -> DataFrame:
    pairs = list(combinations(cols, 2))
    row = df.agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    )
    structs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*structs)))


def average_ranks(
    df: DataFrame, cols: list[str], rows_per_bucket: int = ROWS_PER_BUCKET, n: int | None = None
) -> DataFrame:
    """``(feature, value, rank)``: average rank of every distinct value."""
    ranked = ranked_values(df, cols, {"n": F.lit(1)}, rows_per_bucket, totals=False, n=n)
    mid = F.col("before_n") + (F.col("n") + F.lit(1)) / F.lit(2.0)
    return ranked.select("feature", "value", mid.alias("rank"))


def correlations(
    df: DataFrame, cols: list[str], method: str = "pearson", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """``(a, b, correlation)`` of every column pair.

    Spearman uses rows that are complete in ``cols``. Equal rows are combined
    before the rank tables are joined, and ranks are looked up per distinct
    value, so a dominant value costs one lookup row.
    """
    if method == "pearson":
        return _pearson(df, cols)
    if method != "spearman":
        raise ValueError("method must be 'pearson' or 'spearman'")
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    n = complete.count()
    table = complete.groupBy(*cols).agg(F.count("*").alias("__n"))
    for c in cols:
        ranks = average_ranks(complete.select(c), [c], rows_per_bucket, n)
        table = table.join(ranks.select(F.col("value").alias(c), F.col("rank").alias(f"__r_{c}")), c).drop(c)
    mean = F.lit((n + 1) / 2.0)
    centred = table.select("__n", *[(F.col(f"__r_{c}") - mean).alias(c) for c in cols])
    pairs = list(combinations(cols, 2))
    aggs = [F.sum(F.col("__n") * F.col(c) * F.col(c)).alias(f"v_{c}") for c in cols]
    aggs += [F.sum(F.col("__n") * F.col(a) * F.col(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    structs = [
        F.struct(
            F.lit(a).alias("a"),
            F.lit(b).alias("b"),
            safe_divide(F.col(f"c{i}"), F.sqrt(F.col(f"v_{a}")) * F.sqrt(F.col(f"v_{b}"))).alias("correlation"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return centred.agg(*aggs).select(F.inline(F.array(*structs)))


def conflicts(df: DataFrame, features: list[str], y: str, digest: list[str] = ()) -> DataFrame:
    """Groups of identical features that carry different values of ``y``.

    Grouping combines copies before the shuffle and keeps only min, max and a
    count per group, whatever the group's size. Long text features can be
    compared by digest, as in ``duplicate_rows``.
    """
    groups = digested(df.select(*features, y), list(digest)).groupBy(*features).agg(F.count("*").alias("n"), F.min(y).alias("lo"), F.max(y).alias("hi"))
    clash = groups.where(F.col("lo") != F.col("hi"))
    return clash.agg(
        F.count("*").alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows")
    )
