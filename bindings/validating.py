"""Validation and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import KEY, PROBABILITY_SQL, REF_SQL, CUR_SQL, ROW, SCORED, lines, query, rounded, scored_lines, snapshots, table
from bindings.drifting import bin_sql
from riskloom.operators import drift as D
from riskloom.operators import joins as J
from riskloom.operators import projection as P
from riskloom.operators import validation as V
from riskloom.operators.profile import summary_measures
from riskloom.sources.sinks import batch_statuses, to_batch_response

BOUNDS = {"l_quantity": (2, 48), "l_extendedprice": (1500, 100000), "l_discount": (0, 0.09)}
SCHEMA_BOUNDS = {"l_quantity": (1, 50), "l_extendedprice": (1000, 104000), "l_tax": (0, 0.07)}


def _errors_sql(bounds) -> str:
    parts = ", ".join(
        f"case when not coalesce({c} >= {lo}::double and {c} <= {hi}::double, false) "
        f"then '{c} must be between {lo} and {hi}' end"
        for c, (lo, hi) in bounds.items()
    )
    return f"nullif(concat_ws('; ', {parts}), '')"


def _bad_sql(bounds) -> str:
    return " or ".join(f"{c} < {lo}::double or {c} > {hi}::double" for c, (lo, hi) in bounds.items())


@query(
    "negative_counts",
    """select 'c_acctbal' as feature, count(*) filter (c_acctbal < 0) as n_negative from customer
       union all select 'c_nationkey', count(*) filter (c_nationkey < 0) from customer""",
)
def _(spark, sf):
    return V.negatives(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"])


@query(
    "outlier_counts",
    " union all ".join(
        f"select '{c}' as feature, count(*) filter ({c} < {lo}::double or {c} > {hi}::double) as n_outliers from lineitem"
        for c, (lo, hi) in BOUNDS.items()
    ),
)
def _(spark, sf):
    return V.outliers(lines(spark, sf), BOUNDS)


@query("row_errors", f"select {ROW}, {_errors_sql(BOUNDS)} as errors from lineitem")
def _(spark, sf):
    return V.row_errors(lines(spark, sf), BOUNDS).select(*KEY, "errors")


@query("schema_errors", f"select {ROW}, {_errors_sql(SCHEMA_BOUNDS)} as errors from lineitem")
def _(spark, sf):
    return V.row_errors(lines(spark, sf), SCHEMA_BOUNDS).select(*KEY, "errors")


@query(
    "batch_verdict",
    f"""select l_orderkey as batch_id, count(*) as n_members, count(*) filter ({_bad_sql(BOUNDS)}) as n_invalid,
               count(*) filter ({_bad_sql(BOUNDS)}) = 0 and count(*) <= 1000 as accepted
        from lineitem group by l_orderkey""",
)
def _(spark, sf):
    return V.batch_verdict(lines(spark, sf).withColumnRenamed("l_orderkey", "batch_id"), "batch_id", BOUNDS)


@query(
    "batch_errors",
    f"""select l_orderkey, l_linenumber, l_partkey, {_errors_sql(BOUNDS)} as errors
        from lineitem where {_bad_sql(BOUNDS)}""",
)
def _(spark, sf):
    return V.batch_errors(lines(spark, sf), "l_orderkey", ["l_linenumber", "l_partkey"], BOUNDS)


@query(
    "batch_size",
    "select l_orderkey, count(*) as n_members, count(*) between 1 and 8 as size_ok from lineitem group by l_orderkey",
)
def _(spark, sf):
    return V.batch_size_ok(lines(spark, sf), "l_orderkey", 1, 8)


@query(
    "quarantine_counts",
    f"""select case when {_bad_sql(BOUNDS)} then 'rejected' else 'valid' end as part, count(*) as n,
               cast(sum(l_linenumber) as bigint) as line_sum
        from lineitem group by 1""",
)
def _(spark, sf):
    good, bad = V.quarantine(lines(spark, sf), BOUNDS)
    both = good.select(F.lit("valid").alias("part"), "l_linenumber").unionByName(
        bad.select(F.lit("rejected").alias("part"), "l_linenumber")
    )
    return both.groupBy("part").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("line_sum"))


@query("in_domain", "select o_orderkey, o_orderpriority in ('1-URGENT', '2-HIGH') as in_domain from orders")
def _(spark, sf):
    df = table(spark, sf, "orders")
    return V.in_domain(df, "o_orderpriority", ["1-URGENT", "2-HIGH"]).select("o_orderkey", "in_domain")


@query(
    "low_confidence",
    f"""select {ROW}, greatest({PROBABILITY_SQL}, 1 - {PROBABILITY_SQL}) < 0.75::double as low_confidence from lineitem""",
)
def _(spark, sf):
    return V.low_confidence(P.confidence(scored_lines(spark, sf))).select(*KEY, "low_confidence")


@query(
    "attach_label",
    """select d.doc_id, d.lang, d.n_chars, l.quality, l.toxic from documents d join labels l on d.doc_id = l.doc_id""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return J.attach(docs, table(spark, sf, "labels"), ["doc_id"])


@query(
    "attach_predictions",
    f"""select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, p.prediction
        from lineitem l left join (
          select o_orderkey, case when o_totalprice > 250000 then 1 else 0 end as prediction
          from orders where o_orderstatus <> 'P') p on l.l_orderkey = p.o_orderkey""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
    predictions = orders.select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_totalprice") > 250000).cast("int").alias("prediction")
    )
    return J.attach_predictions(lines(spark, sf).select(*KEY), predictions, ["l_orderkey"])


def _hist_sql(c: str) -> str:
    bin_of = f"cast({bin_sql(c)} as integer)"
    return f"""select '{c}' as feature, {bin_of} as bin,
         count(*) filter ({REF_SQL}) as n_ref, count(*) filter ({CUR_SQL}) as n_cur
       from lineitem, (select min({c}) as lo, max({c}) as hi from lineitem where {REF_SQL}) group by 1, 2"""


@query("compare_hist", " union all ".join(_hist_sql(c) for c in ("l_quantity", "l_extendedprice")))
def _(spark, sf):
    ref, cur = snapshots(lines(spark, sf))
    return D.compare_hist(ref, cur, ["l_quantity", "l_extendedprice"])


@query(
    "batch_response",
    f"""with {SCORED}
        select l_orderkey as batch_id, case when count(*) <= 5 then 'accepted' else 'rejected' end as status,
               count(*) as n_members,
               case when count(*) <= 5 then round(sum(probability), 6) end as probability_sum,
               case when count(*) <= 5 then count(*) end as total,
               case when count(*) <= 5 then count(*) filter (prediction = 1) end as predicted_positive,
               case when count(*) <= 5 then count(*) filter (probability >= 0.7::double) end as high_risk,
               case when count(*) <= 5 then round(avg(probability), 6) end as average_score
        from scored group by l_orderkey""",
)
def _(spark, sf):
    """Every batch; those of more than five members are rejected."""
    scored = scored_lines(spark, sf).withColumnRenamed("l_orderkey", "batch_id")
    docs, oversize = to_batch_response(
        scored,
        "batch_id",
        ["l_linenumber", "l_partkey"],
        ["prediction", "probability"],
        summary_measures("prediction", "probability", inclusive=True),
        limit=5,
    )
    total = F.aggregate("predictions", F.lit(0.0), lambda acc, e: acc + e["probability"])
    return rounded(
        batch_statuses(docs, oversize, "batch_id").select(
            "batch_id",
            "status",
            "n_members",
            total.alias("probability_sum"),
            "summary.total",
            "summary.predicted_positive",
            "summary.high_risk",
            "summary.average_score",
        )
    )
