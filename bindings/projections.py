"""Sources and projections."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from bindings.base import (
    BAND_SQL,
    FEATURES,
    KEY,
    LINES,
    PROBABILITY_SQL,
    ROW,
    lines,
    query,
    rounded,
    scored_lines,
    table,
)
from riskloom.config import RISK_ADVICE
from riskloom.operators import projection as P
from riskloom.sources.tables import explode_requests, load_labeled


@query(
    "load_labeled",
    """select o_orderkey as order_id, o_custkey as customer_id, round(o_totalprice, 6) as amount,
              o_orderpriority, case when o_orderstatus = 'F' then 1 else 0 end as target
       from orders""",
)
def _(spark, sf):
    renames = {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "amount", "absent": "x"}
    df = load_labeled(table(spark, sf, "orders"), "o_orderstatus", "F", "target", renames)
    return rounded(df.drop("o_orderdate"))


@query(
    "explode_requests",
    """select doc_id as batch_id, count(*) as n_members, cast(sum(position) as bigint) as position_sum,
              cast(sum(case when token = '' then 1 else 0 end) as bigint) as n_empty
       from (select doc_id, unnest(string_split(text, ' ')) as token,
                    generate_subscripts(string_split(text, ' '), 1) - 1 as position from documents)
       group by doc_id""",
)
def _(spark, sf):
    words = F.split("text", " ")
    members = F.transform(words, lambda w, i: F.struct(i.cast("bigint").alias("position"), w.alias("token")))
    requests = table(spark, sf, "documents").select(F.col("doc_id").alias("batch_id"), members.alias("patients"))
    return (
        explode_requests(requests)
        .groupBy("batch_id")
        .agg(
            F.count("*").alias("n_members"),
            F.sum("position").alias("position_sum"),
            F.sum((F.col("token") == "").cast("int")).alias("n_empty"),
        )
    )


@query("rename", "select c_custkey as customer_id, c_name as name, c_nationkey, c_mktsegment as segment from customer")
def _(spark, sf):
    df = table(spark, sf, "customer").drop("c_acctbal")
    return P.rename(df, {"c_custkey": "customer_id", "c_name": "name", "c_mktsegment": "segment", "gone": "x"})


@query("binary_label", f"select {ROW}, case when l_returnflag = 'R' then 1 else 0 end as returned from lineitem")
def _(spark, sf):
    return P.binary_label(lines(spark, sf).select(*KEY, "l_returnflag"), "l_returnflag", "R", "returned").drop(
        "l_returnflag"
    )


@query(
    "percentile_label",
    f"""select {ROW}, case when l_extendedprice * (1 - l_discount) > (
            select quantile_cont(l_extendedprice * (1 - l_discount), 0.65) from lineitem) then 1 else 0 end as target
        from lineitem""",
)
def _(spark, sf):
    df = lines(spark, sf).select(*KEY, "l_extendedprice", "l_discount")
    return P.percentile_label(df, "l_extendedprice * (1 - l_discount)", 0.65, "target").select(*KEY, "target")


@query(
    "linear_score",
    f"""select {ROW}, round(l_quantity * 0.02::double + l_extendedprice * 0.0001::double
            + l_discount * 2::double, 6) as risk from lineitem""",
)
def _(spark, sf):
    weights = {"l_quantity": 0.02, "l_extendedprice": 0.0001, "l_discount": 2.0}
    return rounded(P.linear_score(lines(spark, sf), weights, "risk").select(*KEY, "risk"))


@query(
    "clip",
    f"""select {ROW}, least(greatest(l_quantity, 5), 45) as l_quantity,
            least(greatest(l_extendedprice, 2000), 90000) as l_extendedprice from lineitem""",
)
def _(spark, sf):
    df = lines(spark, sf).select(*KEY, "l_quantity", "l_extendedprice")
    return P.clip(df, {"l_quantity": (5, 45), "l_extendedprice": (2000, 90000), "absent": (0, 1)})


@query("drop_target", f"select {ROW}, l_quantity, l_extendedprice, l_discount, l_tax from lineitem")
def _(spark, sf):
    return P.features(lines(spark, sf), ["l_returnflag", "l_linestatus", "l_shipdate"])


@query(
    "zero_to_null",
    f"select {ROW}, nullif(l_discount, 0) as l_discount, nullif(l_tax, 0) as l_tax, l_quantity from lineitem",
)
def _(spark, sf):
    df = P.zero_to_null(lines(spark, sf), ["l_discount", "l_tax", "absent"])
    return df.select(*KEY, "l_discount", "l_tax", "l_quantity")


EDGES, NAMES = (0, 10, 25, 40, 45), ("tiny", "small", "medium", "large")


@query("cut_right", f"select {ROW}, {BAND_SQL} as band from lineitem")
def _(spark, sf):
    return P.cut(lines(spark, sf), "l_quantity", EDGES, NAMES, "band").select(*KEY, "band")


@query(
    "cut_right_lowest",
    f"""select {ROW}, case when l_discount >= 0 and l_discount <= 0.02::double then 'none'
            when l_discount > 0.02::double and l_discount <= 0.05::double then 'low'
            when l_discount > 0.05::double and l_discount <= 0.09::double then 'high' end as band from lineitem""",
)
def _(spark, sf):
    df = P.cut(
        lines(spark, sf), "l_discount", (0, 0.02, 0.05, 0.09), ("none", "low", "high"), "band", include_lowest=True
    )
    return df.select(*KEY, "band")


@query(
    "cut_left",
    f"""select {ROW}, case when l_quantity < 10 then 'few' when l_quantity < 25 then 'some'
            when l_quantity < 40 then 'many' when l_quantity < 50 then 'most' end as band from lineitem""",
)
def _(spark, sf):
    edges = (-math.inf, 10, 25, 40, 50)
    df = P.cut(lines(spark, sf), "l_quantity", edges, ("few", "some", "many", "most"), "band", closed="left")
    return df.select(*KEY, "band")


@query(
    "dummies",
    f"""select {ROW}, coalesce(band = 'small', false) as band_small, coalesce(band = 'medium', false) as band_medium,
            coalesce(band = 'large', false) as band_large, band is null as band_unknown
        from (select *, {BAND_SQL} as band from lineitem)""",
)
def _(spark, sf):
    df = P.cut(lines(spark, sf), "l_quantity", EDGES, NAMES, "band").select(*KEY, "band")
    return P.dummies(df, {"band": list(NAMES)}, unknown=True)


@query("interaction", f"select {ROW}, round(l_extendedprice * l_discount, 6) as rebate from lineitem")
def _(spark, sf):
    return rounded(P.interaction(lines(spark, sf), "l_extendedprice", "l_discount", "rebate").select(*KEY, "rebate"))


@query(
    "safe_ratio",
    f"select {ROW}, round(l_extendedprice / (l_quantity + 0.00000001::double), 6) as unit_price from lineitem",
)
def _(spark, sf):
    return rounded(P.safe_ratio(lines(spark, sf), "l_extendedprice", "l_quantity", "unit_price").select(*KEY, "unit_price"))


@query(
    "flag_gt",
    f"select {ROW}, case when nullif(l_tax, 0) > 0.04::double then 1 else 0 end as taxed from lineitem",
)
def _(spark, sf):
    df = P.zero_to_null(lines(spark, sf), ["l_tax"])
    return P.flag_gt(df, "l_tax", 0.04, "taxed").select(*KEY, "taxed")


@query("align", f"select {ROW}, 0 as absent, l_tax, l_quantity from lineitem")
def _(spark, sf):
    return P.align(lines(spark, sf), [*KEY, "absent", "l_tax", "l_quantity"])


ENGINEERED_SQL = f"""engineered as (
  select {ROW}, l_returnflag, l_quantity, l_extendedprice, d as l_discount, t as l_tax,
         l_extendedprice * d as rebate, l_extendedprice / (l_quantity + 0.00000001::double) as unit_price,
         case when l_quantity > 25 then 1 else 0 end as bulk,
         l_quantity > 10 and l_quantity <= 25 as quantity_band_small,
         l_quantity > 25 and l_quantity <= 40 as quantity_band_medium,
         l_quantity > 40 and l_quantity <= 50 as quantity_band_large,
         l_extendedprice > 30000 and l_extendedprice <= 60000 as price_band_mid,
         l_extendedprice > 60000 and l_extendedprice <= 90000 as price_band_high
  from (select *, nullif(l_discount, 0) as d, nullif(l_tax, 0) as t from lineitem))"""


@query(
    "engineer",
    f"""with {ENGINEERED_SQL}
        select * exclude (l_returnflag, rebate, unit_price), round(rebate, 6) as rebate,
               round(unit_price, 6) as unit_price from engineered""",
)
def _(spark, sf):
    return rounded(P.engineer(lines(spark, sf).select(*KEY, *FEATURES), LINES))


@query(
    "confidence",
    f"""select {ROW}, round(greatest({PROBABILITY_SQL}, 1 - {PROBABILITY_SQL}), 6) as confidence_score from lineitem""",
)
def _(spark, sf):
    return rounded(P.confidence(scored_lines(spark, sf)).select(*KEY, "confidence_score"))


@query(
    "risk_category",
    f"""select {ROW},
          case when p < 0.3::double then 'Low Risk' when p < 0.7::double then 'Medium Risk' else 'High Risk' end
            as risk_category,
          case when p < 0.3::double then 'Maintain healthy lifestyle. Regular checkups recommended.'
               when p < 0.7::double then 'Lifestyle modifications recommended. Consult healthcare provider.'
               else 'Immediate medical consultation recommended.' end as recommendation,
          case when p > 0 and p <= 0.3::double then 'Low Risk' when p > 0.3::double and p <= 0.7::double then 'Medium Risk'
               when p > 0.7::double and p <= 1 then 'High Risk' end as table_category
        from (select *, {PROBABILITY_SQL} as p from lineitem)""",
)
def _(spark, sf):
    df = P.risk_category(scored_lines(spark, sf), advice=RISK_ADVICE)
    df = P.risk_category(df, closed="right", out="table_category")
    return df.select(*KEY, "risk_category", "recommendation", "table_category")
