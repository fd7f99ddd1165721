"""Profiles, group rates and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import BAND_SQL, FEATURES, REF_SQL, CUR_SQL, SCORED, lines, query, rounded, scored_lines, snapshots, table
from riskloom.functions import cut_column
from riskloom.operators import fairness as B
from riskloom.operators import profile as A
from riskloom.operators import projection as P
from riskloom.operators.ordered import percentiles


def band():
    """Quantity band; quantities above 45 belong to no group."""
    return cut_column("l_quantity", (0, 10, 25, 40, 45), ("tiny", "small", "medium", "large"))


@query("shape", "select count(*) as n_rows, 11::bigint as n_columns from lineitem")
def _(spark, sf):
    return A.shape(lines(spark, sf))


@query(
    "missing_report",
    " union all ".join(
        f"select '{c}' as feature, count(*) filter (nullif({c}, 0) is null) as n_missing, "
        f"round(count(*) filter (nullif({c}, 0) is null) * 100 / count(*), 6) as pct_missing from lineitem"
        for c in FEATURES
    ),
)
def _(spark, sf):
    df = P.zero_to_null(lines(spark, sf).select(*FEATURES), FEATURES)
    return rounded(A.missing_report(df))


@query(
    "duplicate_rows",
    """select cast(coalesce(sum(n - 1), 0) as bigint) as n_duplicates
       from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)""",
)
def _(spark, sf):
    return A.duplicate_rows(lines(spark, sf), ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_texts",
    "select cast(coalesce(sum(n - 1), 0) as bigint) as n_duplicates from (select count(*) as n from documents group by text, lang)",
)
def _(spark, sf):
    return A.duplicate_rows(table(spark, sf, "documents"), ["text", "lang"], digest=["text"])


@query(
    "value_counts",
    """select o_orderpriority, count(*) as n, round(count(*) * 100 / (select count(*) from orders), 6) as pct
       from orders group by o_orderpriority""",
)
def _(spark, sf):
    return rounded(A.value_counts(table(spark, sf, "orders"), "o_orderpriority"))


@query(
    "distribution_shift",
    f"""select l_returnflag, round(a, 6) as share_a, round(b, 6) as share_b, round(abs(a - b), 6) as abs_diff
        from (select l_returnflag,
                count(*) filter ({REF_SQL}) / (select count(*) from lineitem where {REF_SQL}) as a,
                count(*) filter ({CUR_SQL}) / (select count(*) from lineitem where {CUR_SQL}) as b
              from lineitem group by l_returnflag)""",
)
def _(spark, sf):
    ref, cur = snapshots(lines(spark, sf))
    return rounded(A.distribution_shift(ref, cur, "l_returnflag"))


@query(
    "describe",
    " union all ".join(
        f"""select '{c}' as feature, count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
              min({c}) as min, round(quantile_cont({c}, 0.25), 6) as q1, round(quantile_cont({c}, 0.5), 6) as median,
              round(quantile_cont({c}, 0.75), 6) as q3, max({c}) as max from lineitem"""
        for c in FEATURES
    ),
)
def _(spark, sf):
    return rounded(A.describe(lines(spark, sf), FEATURES))


@query(
    "percentiles",
    " union all ".join(
        f"select '{c}' as feature, {p}::double as p, round(quantile_cont({c}, {p}), 6) as value from lineitem"
        for c in FEATURES
        for p in (0.01, 0.25, 0.5, 0.65, 0.99)
    ),
)
def _(spark, sf):
    return rounded(percentiles(lines(spark, sf), FEATURES, [0.01, 0.25, 0.5, 0.65, 0.99]))


@query(
    "percentiles_by_selection",
    " union all ".join(
        f"select '{c}' as feature, {p}::double as p, round(quantile_cont({c}, {p}), 6) as value from lineitem"
        for c in FEATURES
        for p in (0.1, 0.5, 0.9)
    ),
)
def _(spark, sf):
    # The route for tables too large for the built-in exact aggregate, forced here by a low switch point.
    return rounded(percentiles(lines(spark, sf), FEATURES, [0.1, 0.5, 0.9]))


@query(
    "group_stats",
    f"""with {SCORED} select band, count(label) as n, round(avg(label), 3) as mean
        from (select *, {BAND_SQL} as band from scored) where band is not null group by band""",
)
def _(spark, sf):
    return A.group_stats(scored_lines(spark, sf).withColumn("band", band()), "band", "label")


@query(
    "group_rates",
    f"""with {SCORED} select band, count(*) as n, round(avg(prediction), 6) as rate
        from (select *, {BAND_SQL} as band from scored) where band is not null group by band""",
)
def _(spark, sf):
    return rounded(B.group_rates(scored_lines(spark, sf).withColumn("band", band()), "band", "prediction"))


@query(
    "parity_difference",
    f"""with {SCORED} select round(max(rate) - min(rate), 6) as parity_difference
        from (select band, avg(prediction) as rate from (select *, {BAND_SQL} as band from scored)
              where band is not null group by band)""",
)
def _(spark, sf):
    return rounded(B.parity_difference(scored_lines(spark, sf).withColumn("band", band()), "band", "prediction"))


@query(
    "fairness",
    f"""with {SCORED}, long as (
          select 'quantity' as feature, {BAND_SQL} as grp, prediction from scored
          union all select 'returnflag', l_returnflag, prediction from scored
          union all select 'linestatus', l_linestatus, prediction from scored),
        rates as (select feature, grp, avg(prediction) as rate from long where grp is not null group by 1, 2)
        select feature, count(*) as n_groups, round(min(rate), 6) as min_rate, round(max(rate), 6) as max_rate,
               round(max(rate) - min(rate), 6) as parity_difference from rates group by feature""",
)
def _(spark, sf):
    specs = {"quantity": band(), "returnflag": "l_returnflag", "linestatus": "l_linestatus"}
    return rounded(B.fairness(scored_lines(spark, sf), specs, "prediction"))


@query(
    "fairness_by_segment",
    f"""with {SCORED}, long as (
          select 'segment' as feature, c_mktsegment as grp, prediction
          from scored join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
          union all
          select 'priority', o_orderpriority, prediction from scored join orders on l_orderkey = o_orderkey
             join customer on o_custkey = c_custkey)
        select feature, grp, count(*) as n, round(avg(prediction), 6) as rate from long group by 1, 2""",
)
def _(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    people = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    joined = scored_lines(spark, sf).select("l_orderkey", "prediction").join(
        people, F.col("l_orderkey") == F.col("o_orderkey")
    )
    specs = {"segment": "c_mktsegment", "priority": "o_orderpriority"}
    return rounded(B.fairness_rates(joined, specs, "prediction"))


SUMMARY_SQL = """count(*) as total, count(*) filter (prediction = 1) as predicted_positive,
    count(*) filter (prediction <> 1) as predicted_negative, count(*) filter (probability > 0.7::double) as high_risk,
    round(avg(probability), 6) as average_score"""


@query("prediction_summary", f"with {SCORED} select {SUMMARY_SQL} from scored")
def _(spark, sf):
    return rounded(A.prediction_summary(scored_lines(spark, sf)))


@query(
    "batch_summary",
    f"""with {SCORED} select l_orderkey, {SUMMARY_SQL.replace("> 0.7", ">= 0.7")} from scored group by l_orderkey""",
)
def _(spark, sf):
    return rounded(A.prediction_summary(scored_lines(spark, sf), keys=["l_orderkey"], inclusive=True))


@query(
    "profile",
    " union all ".join(
        f"select '{c}' as feature, min({c})::double as min, max({c})::double as max, count(distinct {c}) as n_unique from lineitem"
        for c in [*FEATURES, "l_suppkey"]
    ),
)
def _(spark, sf):
    return A.profile(lines(spark, sf), [*FEATURES, "l_suppkey"])


@query(
    "profile_types",
    """select 'big' as feature, min(l_orderkey + 9007199254740992)::double as min, max(l_orderkey + 9007199254740992)::double as max,
              count(distinct l_orderkey) as n_unique from lineitem
       union all select 'l_linestatus', null, null, count(distinct l_linestatus) from lineitem
       union all select 'l_shipdate', null, null, count(distinct l_shipdate) from lineitem""",
)
def _(spark, sf):
    """Ids beyond 2**53, text and times keep their exact distinct counts."""
    df = lines(spark, sf).withColumn("big", F.col("l_orderkey") + F.lit(1 << 53))
    return A.profile(df, ["big", "l_linestatus", "l_shipdate"])


@query(
    "imbalance",
    """select round(min(n) / sum(n), 6) as minority_ratio
       from (select count(*) as n from labels where quality is not null group by quality)""",
)
def _(spark, sf):
    return rounded(A.imbalance(table(spark, sf, "labels"), "quality"))
