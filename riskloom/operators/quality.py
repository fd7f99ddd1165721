"""Data-quality suite (DQ rows): one row per test plus totals.

The reference behaviour gives no pass rule for the counting tests; ours is
"current <= reference" unless ``SuiteConfig.fixed_limits`` names a bound. The
drift test passes while fewer than a third of the columns drift. Types are compared
first: a column whose types cannot be united fails that test, counts as drifted and
is left out of the statistics of the others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import SuiteConfig
from riskloom.operators.drift import column_drift, comparable
from riskloom.operators.joins import tag_snapshots

RESULT_SCHEMA = "position int, test string, feature string, status string, value double, lower double, upper double"


def snapshot_stats(ref: DataFrame, cur: DataFrame, cols: list[str], numeric: list[str]) -> dict[str, dict]:
    """Counts, nulls, ranges, means of both snapshots: one aggregation, two result rows."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    aggs = [F.count("*").alias("rows"), F.count_if(any_null).alias("rows_missing")]
    for i, c in enumerate(cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"null{i}"))
        aggs.append(F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(f"constant{i}"))
    for c in numeric:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"min_{c}"), F.max(x).alias(f"max_{c}")]
        aggs += [F.avg(x).alias(f"avg_{c}"), F.stddev_samp(x).alias(f"std_{c}")]
    rows = tag_snapshots(ref, cur, cols).groupBy("is_ref").agg(*aggs).collect()
    stats = {r["is_ref"]: r.asDict() for r in rows}
    empty = {"rows": 0, "rows_missing": 0}
    out = {}
    for side, name in ((1, "ref"), (0, "cur")):
        s = stats.get(side, empty)
        s["columns_missing"] = sum(1 for i in range(len(cols)) if s.get(f"null{i}", 0) > 0)
        s["constant_columns"] = sum(1 for i in range(len(cols)) if s.get(f"constant{i}", False))
        cells = s["rows"] * len(cols)
        s["missing_share"] = sum(s.get(f"null{i}", 0) for i in range(len(cols))) / cells if cells else 0.0
        out[name] = s
    return out


def duplicate_counts(ref: DataFrame, cur: DataFrame, cols: list[str]) -> dict[str, int]:
    """Repeated rows of both snapshots in one grouped aggregation."""
    groups = tag_snapshots(ref, cur, cols).groupBy("is_ref", *cols).agg(F.count("*").alias("n"))
    rows = groups.groupBy("is_ref").agg(F.sum(F.col("n") - 1).alias("d")).collect()
    found = {r["is_ref"]: int(r["d"]) for r in rows}
    return {"ref": found.get(1, 0), "cur": found.get(0, 0)}


def run_suite(
    ref: DataFrame, cur: DataFrame, suite: SuiteConfig, cols: list[str], numeric: list[str]
) -> DataFrame:
    """Every test of the suite as a row; a test whose column is absent has status ERROR."""
    shared = [c for c in cols if comparable(ref, cur, c)]
    used = [c for c in numeric if c in shared]
    stats = snapshot_stats(ref, cur, shared, used)
    copies = duplicate_counts(ref, cur, shared)
    r, c = stats["ref"], stats["cur"]
    rows: list[tuple] = []

    def add(test, feature, ok, value, lower=None, upper=None):
        status = "ERROR" if ok is None else "SUCCESS" if ok else "FAIL"
        as_float = [None if v is None else float(v) for v in (value, lower, upper)]
        rows.append((len(rows) + 1, test, feature, status, *as_float))

    def limit(test, value, reference):
        bound = suite.fixed_limits.get(test, reference)
        add(test, "", value <= bound, value, None, bound)

    limit("columns_with_missing", c["columns_missing"], r["columns_missing"])
    limit("rows_with_missing", c["rows_missing"], r["rows_missing"])
    limit("constant_columns", c["constant_columns"], r["constant_columns"])
    limit("duplicated_rows", copies["cur"], copies["ref"])
    types_ref = {f.name: f.dataType.simpleString() for f in ref.schema}
    types_cur = {f.name: f.dataType.simpleString() for f in cur.schema}
    wrong = sum(1 for name in cols if types_ref.get(name) != types_cur.get(name))
    add("column_types", "", wrong == 0, wrong, None, 0)
    limit("missing_share", c["missing_share"], r["missing_share"])
    for name, (lo, hi) in suite.ranges.items():
        low, high = c.get(f"min_{name}"), c.get(f"max_{name}")
        if low is None:
            add("value_range", name, None, None, lo, hi)
        else:
            add("value_range", name, low >= lo and high <= hi, low if low < lo else high, lo, hi)
    for name in suite.means:
        mean, centre, std = c.get(f"avg_{name}"), r.get(f"avg_{name}"), r.get(f"std_{name}")
        if mean is None or centre is None:
            add("mean_in_sigmas", name, None, None)
            continue
        reach = suite.sigmas * (std or 0.0)
        add("mean_in_sigmas", name, abs(mean - centre) <= reach, mean, centre - reach, centre + reach)
    scores = column_drift(ref, cur, {c: "psi" for c in numeric}, {"psi": suite.psi_threshold}, suite.psi_bins)
    drifted = scores.where("drifted").count()
    allowed = suite.fixed_limits.get("drifted_columns", max(0, len(numeric) // 3 - 1))
    add("drifted_columns", "", drifted <= allowed, drifted, None, allowed)
    return ref.sparkSession.createDataFrame(rows, RESULT_SCHEMA)


def suite_summary(results: DataFrame) -> DataFrame:
    """Totals; anything that is not SUCCESS counts as failed."""
    return results.agg(
        F.count("*").alias("total_tests"),
        F.count_if(F.col("status") == "SUCCESS").alias("passed_tests"),
        F.count_if(F.col("status") != "SUCCESS").alias("failed_tests"),
    )
