"""Drift, correlations, quality suite, conflicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import CUR_SQL, FEATURES, REF_SQL, SCORED, lines, query, rounded, scored_lines, snapshots, table
from riskloom.config import SuiteConfig
from riskloom.functions.special import normal_two_sided
from riskloom.operators import drift as D
from riskloom.operators import quality as Q
from riskloom.operators.projection import zero_to_null

COLS = ["l_quantity", "l_extendedprice", "l_discount"]
CATS = ["l_returnflag", "l_linestatus"]


def bin_sql(c: str) -> str:
    return f"""case when {c} < lo then -1 when {c} > hi then 10 when {c} is null then null when hi = lo then 0
      else least(floor(({c} - lo) / ((hi - lo) / 10)), 9) end"""


def _psi_sql(c: str, source: str = "lineitem") -> str:
    bin_of = bin_sql(c)
    return f"""select '{c}' as feature, sum((c - r) * ln(c / r)) as psi from (
        select greatest(n_ref / sum(n_ref) over (), 0.0001::double) as r,
               greatest(n_cur / sum(n_cur) over (), 0.0001::double) as c
        from (select {bin_of} as bin, count(*) filter ({REF_SQL}) as n_ref, count(*) filter ({CUR_SQL}) as n_cur
              from {source}, (select min({c}) as lo, max({c}) as hi from {source} where {REF_SQL})
              where {c} is not null group by 1))"""


def _shares_sql(c: str) -> str:
    return f"""(select n_ref, n_cur, sum(n_ref) over () as total_ref, sum(n_cur) over () as total_cur,
          n_ref / sum(n_ref) over () as r, n_cur / sum(n_cur) over () as c from (
        select {c}, count(*) filter ({REF_SQL}) as n_ref, count(*) filter ({CUR_SQL}) as n_cur
        from lineitem group by 1))"""


def _gaps_sql(c: str) -> str:
    return f"""(select v, lead(v) over (order by v) as nxt,
          abs(sum(n_ref) over (order by v) / sum(n_ref) over () - sum(n_cur) over (order by v) / sum(n_cur) over ()) as gap
        from (select {c} as v, count(*) filter ({REF_SQL}) as n_ref, count(*) filter ({CUR_SQL}) as n_cur
              from lineitem group by 1))"""


def _w_sql(c: str) -> str:
    return f"""select '{c}' as feature, sum(gap * (nxt - v)) / (select stddev_pop({c}) from lineitem where {REF_SQL})
        as wasserstein from {_gaps_sql(c)}"""


def _js_sql(c: str) -> str:
    return f"""select '{c}' as feature,
          sum((case when r > 0 then r * ln(r / ((r + c) / 2)) else 0 end
             + case when c > 0 then c * ln(c / ((r + c) / 2)) else 0 end) / 2) as js_divergence from {_shares_sql(c)}"""


def _both(spark, sf):
    return snapshots(lines(spark, sf))


@query(
    "psi", f"select feature, round(psi, 6) as psi from ({' union all '.join(_psi_sql(c) for c in COLS)})"
)
def _(spark, sf):
    return rounded(D.psi(*_both(spark, sf), COLS))


@query(
    "psi_categorical",
    "select feature, round(psi, 6) as psi from ("
    + " union all ".join(
        f"""select '{c}' as feature, sum((c - r) * ln(c / r)) as psi from (select greatest(r, 0.0001::double) as r,
            greatest(c, 0.0001::double) as c from {_shares_sql(c)})"""
        for c in CATS
    )
    + ")",
)
def _(spark, sf):
    return rounded(D.psi_cat(*_both(spark, sf), CATS))


@query(
    "js_divergence",
    f"""select feature, round(js_divergence, 6) as js_divergence,
          round(sqrt(greatest(js_divergence, 0) / ln(2)), 6) as js_distance
        from ({' union all '.join(_js_sql(c) for c in CATS)})""",
)
def _(spark, sf):
    return rounded(D.js_divergence(*_both(spark, sf), CATS))


def _ks_p_sql() -> str:
    return """case when lam < 0.2::double then 1 else least(greatest(
         list_sum(list_transform(range(1, 101), lambda k: (case when k % 2 = 1 then 2 else -2 end)::double
           * exp(-2::double * k * k * lam * lam))), 0), 1) end"""


def _ks_sql(c: str) -> str:
    return f"""select '{c}' as feature, (select max(gap) from {_gaps_sql(c)}) as ks,
       (select count(*) from lineitem where {REF_SQL})::double as n,
       (select count(*) from lineitem where {CUR_SQL})::double as m"""


@query(
    "ks",
    f"""select feature, round(ks, 6) as ks, round({_ks_p_sql()}, 6) as p_value from (
          select *, (sqrt(n * m / (n + m)) + 0.12::double + 0.11::double / sqrt(n * m / (n + m))) * ks as lam
          from ({' union all '.join(_ks_sql(c) for c in COLS)}))""",
)
def _(spark, sf):
    return rounded(D.ks(*_both(spark, sf), COLS))


@query(
    "ks_bucketed",
    f"select feature, round(ks, 6) as ks from ({' union all '.join(_ks_sql(c) for c in FEATURES)})",
)
def _(spark, sf):
    # Several value buckets per column: the route for many distinct values.
    return rounded(D.ks(*_both(spark, sf), FEATURES, rows_per_bucket=7_000)).drop("p_value")


@query(
    "wasserstein",
    f"select feature, round(wasserstein, 6) as wasserstein from ({' union all '.join(_w_sql(c) for c in COLS)})",
)
def _(spark, sf):
    return rounded(D.wasserstein(*_both(spark, sf), COLS))


@query(
    "wasserstein_bucketed",
    f"select feature, round(wasserstein, 6) as wasserstein from ({' union all '.join(_w_sql(c) for c in COLS)})",
)
def _(spark, sf):
    return rounded(D.wasserstein(*_both(spark, sf), COLS, rows_per_bucket=7_000))


def _chi2_sql(cats: list[str]) -> str:
    return " union all ".join(
        f"""select '{c}' as feature, count(*) - 1 as dof,
          sum(power(n_ref - total_ref * q, 2) / (total_ref * q) + power(n_cur - total_cur * q, 2) / (total_cur * q)) as chi2
        from (select *, (n_ref + n_cur) / (total_ref + total_cur) as q from {_shares_sql(c)})"""
        for c in cats
    )


@query("chi2_stat", f"select feature, round(chi2, 6) as chi2, dof from ({_chi2_sql(CATS)})")
def _(spark, sf):
    return rounded(D.chi2_stat(*_both(spark, sf), CATS))


PROP_SQL = (
    "select feature, (x2 / n2 - x1 / n1) / sqrt(((x1 + x2) / (n1 + n2)) * (1 - (x1 + x2) / (n1 + n2)) * (1 / n1 + 1 / n2)) as z from ("
    + " union all ".join(
        f"""select '{name}' as feature, count(*) filter ({REF_SQL}) as n1, count(*) filter ({CUR_SQL}) as n2,
              count(*) filter ({REF_SQL} and {test}) as x1, count(*) filter ({CUR_SQL} and {test}) as x2 from lineitem"""
        for name, test in (
            ("returned", "l_returnflag = 'R'"),
            ("open", "l_linestatus = 'O'"),
            ("taxed", "l_tax > 0"),
            ("large", "l_quantity > 40"),
        )
    )
    + ")"
)


def _proportions():
    return {
        "returned": F.col("l_returnflag") == "R",
        "open": F.col("l_linestatus") == "O",
        "taxed": F.col("l_tax") > 0,
        "large": F.col("l_quantity") > 40,
    }


@query("prop_z", f"select feature, round(z, 6) + 0::double as z from ({PROP_SQL})")
def _(spark, sf):
    return rounded(D.prop_z(*_both(spark, sf), _proportions()))


TESTED = [*CATS, "l_linenumber", "l_quantity", "l_tax"]
#: P(X >= x) of a chi-square variable in SQL: one less the series of its lower half.
CHI2_TAIL_SQL = """case when {x} is null then null when {x} <= 0 or {k} <= 0 then 1::double else
  greatest(0::double, least(1::double, 1 - list_sum(list_transform(range(0, ({x} / 2 + 12 * sqrt({x} / 2 + {k}) + 60)::bigint),
    lambda i: exp(({k} / 2::double + i) * ln({x} / 2) - {x} / 2 - lgamma({k} / 2::double + i + 1)))))) end"""


@query(
    "chi2_p",
    f"with s as ({_chi2_sql(TESTED)}) select feature, round({CHI2_TAIL_SQL.format(x='chi2', k='dof')}, 6) + 0::double as p_value from s",
)
def _(spark, sf):
    return rounded(D.chi2(*_both(spark, sf), TESTED).select("feature", "p_value"))


@query(
    "prop_z_p",
    f"with s as ({PROP_SQL}) select feature, round({CHI2_TAIL_SQL.format(x='(z * z)', k='1')}, 6) + 0::double as p_value from s",
)
def _(spark, sf):
    tested = D.prop_z(*_both(spark, sf), _proportions())
    return rounded(tested.select("feature", normal_two_sided(F.col("z")).alias("p_value")))


METHODS = {"l_quantity": "psi", "l_extendedprice": "psi", "l_discount": "wasserstein", "l_returnflag": "js"}
LIMITS = {"psi": 0.0005, "wasserstein": 0.02, "js": 0.02}


@query(
    "dataset_drift",
    f"""with scores as (
          select feature, psi as score, {LIMITS["psi"]}::double as threshold
            from ({_psi_sql("l_quantity")} union all {_psi_sql("l_extendedprice")})
          union all select feature, wasserstein, {LIMITS["wasserstein"]}::double from ({_w_sql("l_discount")})
          union all select feature, sqrt(greatest(js_divergence, 0) / ln(2)), {LIMITS["js"]}::double
            from ({_js_sql("l_returnflag")}))
        select count(*) as n_columns, count(*) filter (score >= threshold) as n_drifted,
               round(avg((score >= threshold)::int), 6) as drift_share, avg((score >= threshold)::int) >= 0.5 as dataset_drift
        from scores""",
)
def _(spark, sf):
    return rounded(D.dataset_drift(*_both(spark, sf), METHODS, LIMITS))


@query(
    "column_drift",
    f"""select feature, method, round(score, 6) as score, threshold, score >= threshold as drifted, 'ok' as status from (
          select feature, 'psi' as method, psi as score, {LIMITS["psi"]}::double as threshold
            from ({_psi_sql("l_quantity")} union all {_psi_sql("l_extendedprice")})
          union all select feature, 'wasserstein', wasserstein, {LIMITS["wasserstein"]}::double from ({_w_sql("l_discount")})
          union all select feature, 'js', sqrt(greatest(js_divergence, 0) / ln(2)), {LIMITS["js"]}::double
            from ({_js_sql("l_returnflag")}))""",
)
def _(spark, sf):
    return rounded(D.column_drift(*_both(spark, sf), METHODS, LIMITS))


# lineitem with a vanished, a constant, a retyped, a new and an always empty column
_DAMAGED = {"l_quantity": "psi", "l_extendedprice": "ks", "l_discount": "wasserstein", "l_returnflag": "js", "l_tax": "psi",
            "fresh": "psi", "nothing": "ks", "other": "psi"}


def _damaged(spark, sf):
    ref, cur = _both(spark, sf)
    none = F.lit(None).cast("double")
    ref = ref.withColumns({"l_tax": F.lit(5.0), "fresh": none, "nothing": none, "other": F.lit(1.0)})
    cur = cur.withColumns(
        {c: none for c in ("l_quantity", "l_extendedprice", "l_discount", "nothing")} | {"l_tax": F.lit(100.0), "fresh": F.lit(1.0)}
    ).withColumns({"l_returnflag": F.lit(None).cast("string"), "other": F.lit("one")})
    return ref, cur


@query(
    "column_drift_missing",
    """select * from (values
         ('l_quantity', 'psi', null::double, 0.2::double, true, 'no_current'),
         ('l_extendedprice', 'ks', null, 0.05, true, 'no_current'),
         ('l_discount', 'wasserstein', null, 0.1, true, 'no_current'),
         ('l_returnflag', 'js', null, 0.1, true, 'no_current'),
         ('l_tax', 'psi', round(2 * (1 - 0.0001::double) * ln(1 / 0.0001::double), 6), 0.2, true, 'ok'),
         ('fresh', 'psi', null, 0.2, true, 'no_reference'),
         ('nothing', 'ks', null, 0.05, false, 'no_data'),
         ('other', 'psi', null, 0.2, true, 'type_changed')) t(feature, method, score, threshold, drifted, status)
       where (select count(*) from lineitem) > 0""",
)
def _(spark, sf):
    """Every asked column appears, whatever happened to it."""
    return rounded(D.column_drift(*_damaged(spark, sf), _DAMAGED))


@query(
    "psi_constant",
    f"""select feature, round(sum((greatest(c, 0.0001::double) - greatest(r, 0.0001::double))
          * ln(greatest(c, 0.0001::double) / greatest(r, 0.0001::double))), 6) as psi
        from (select 'l_quantity' as feature, count(*) filter ({REF_SQL}) / (select count(*) from lineitem where {REF_SQL}) as r,
                     count(*) filter ({CUR_SQL}) / (select count(*) from lineitem where {CUR_SQL}) as c
              from (select *, case when {REF_SQL} or l_quantity = 20 then 0 when l_quantity < 20 then -1 else 1 end as bin
                    from lineitem) group by bin) group by feature""",
)
def _(spark, sf):
    """The reference is 20 throughout."""
    ref, cur = _both(spark, sf)
    return rounded(D.psi(ref.withColumn("l_quantity", F.lit(20.0)), cur, ["l_quantity"]))


@query(
    "missing_compare",
    """select feature, missing_ref, missing_cur, round(missing_ref / n_ref, 6) as share_ref,
              round(missing_cur / n_cur, 6) as share_cur from ("""
    + " union all ".join(
        f"""select '{c}' as feature, count(*) filter ({REF_SQL} and nullif({c}, 0) is null) as missing_ref,
              count(*) filter ({CUR_SQL} and nullif({c}, 0) is null) as missing_cur,
              count(*) filter ({REF_SQL}) as n_ref, count(*) filter ({CUR_SQL}) as n_cur from lineitem"""
        for c in ("l_discount", "l_tax")
    )
    + ")",
)
def _(spark, sf):
    ref, cur = snapshots(zero_to_null(lines(spark, sf), ["l_discount", "l_tax"]))
    return rounded(D.missing_compare(ref, cur, ["l_discount", "l_tax"]))


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]


@query(
    "corr_pearson",
    " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) + 0::double as correlation from lineitem"
        for a, b in _pairs(FEATURES)
    ),
)
def _(spark, sf):
    return rounded(D.correlations(lines(spark, sf), FEATURES))


def _rank_sql(c: str) -> str:
    return f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2 as r_{c}"


@query(
    "corr_spearman",
    f"with ranks as (select {', '.join(_rank_sql(c) for c in COLS)} from lineitem) "
    + " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr(r_{a}, r_{b}), 6) + 0::double as correlation from ranks"
        for a, b in _pairs(COLS)
    ),
)
def _(spark, sf):
    return rounded(D.correlations(lines(spark, sf), COLS, "spearman"))


SUITE = SuiteConfig(
    ranges={"l_quantity": (1, 50), "l_extendedprice": (950, 104000)}, means=("l_quantity", "l_discount")
)
SUITE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag"]
SUITE_NUM = ["l_quantity", "l_extendedprice", "l_discount"]


def _side(name: str, test: str) -> str:
    nulls = " + ".join(f"count(*) filter ({c} is null)" for c in SUITE_COLS)
    return f"""{name} as (select count(*) as n_rows,
        {" + ".join(f"(count(*) filter ({c} is null) > 0)::int" for c in SUITE_COLS)} as columns_missing,
        count(*) filter ({" or ".join(f"{c} is null" for c in SUITE_COLS)}) as rows_missing,
        {" + ".join(f"coalesce(min({c}) = max({c}), true)::int" for c in SUITE_COLS)} as constant_columns,
        ({nulls}) / (count(*) * {len(SUITE_COLS)}) as missing_share,
        (select coalesce(sum(n - 1), 0) from (select count(*) as n from l where {test} group by {", ".join(SUITE_COLS)}))
          as copies,
        {", ".join(f"min({c}) as min_{c}, max({c}) as max_{c}, avg({c}) as avg_{c}, stddev_samp({c}) as std_{c}" for c in SUITE_NUM)}
      from l where {test})"""


_UNION = " union all ".join(_psi_sql(c, "l") for c in SUITE_NUM)
DQ_SQL = f"""l as (select * replace (nullif(l_discount, 0) as l_discount) from lineitem),
  {_side("r", REF_SQL)}, {_side("c", CUR_SQL)}, p as (select count(*) as d from ({_UNION}) where psi >= 0.2::double),
  sides as (select r.n_rows as rn, c.columns_missing as c1, r.columns_missing as r1, c.rows_missing as c2, r.rows_missing as r2,
       c.constant_columns as c3, r.constant_columns as r3, c.copies as c4, r.copies as r4, c.missing_share as c6,
       r.missing_share as r6, c.min_l_quantity as q0, c.max_l_quantity as q1, c.min_l_extendedprice as e0,
       c.max_l_extendedprice as e1, c.avg_l_quantity as mq, r.avg_l_quantity as rq, r.std_l_quantity as sq,
       c.avg_l_discount as md, r.avg_l_discount as rd, r.std_l_discount as sd, p.d as d from r, c, p),
  tests as (
    select 1 as position, 'columns_with_missing' as test, '' as feature, c1 <= r1 as ok, c1::double as value,
           null::double as lower, r1::double as upper from sides
    union all select 2, 'rows_with_missing', '', c2 <= r2, c2, null, r2 from sides
    union all select 3, 'constant_columns', '', c3 <= r3, c3, null, r3 from sides
    union all select 4, 'duplicated_rows', '', c4 <= r4, c4, null, r4 from sides
    union all select 5, 'column_types', '', true, 0, null, 0 from sides
    union all select 6, 'missing_share', '', c6 <= r6, c6, null, r6 from sides
    union all select 7, 'value_range', 'l_quantity', q0 >= 1 and q1 <= 50, case when q0 < 1 then q0 else q1 end, 1, 50 from sides
    union all select 8, 'value_range', 'l_extendedprice', e0 >= 950 and e1 <= 104000,
        case when e0 < 950 then e0 else e1 end, 950, 104000 from sides
    union all select 9, 'mean_in_sigmas', 'l_quantity', abs(mq - rq) <= 2 * sq, mq, rq - 2 * sq, rq + 2 * sq from sides
    union all select 10, 'mean_in_sigmas', 'l_discount', abs(md - rd) <= 2 * sd, md, rd - 2 * sd, rd + 2 * sd from sides
    union all select 11, 'drifted_columns', '', d <= 0, d, null, 0 from sides)"""


def _suite(spark, sf):
    ref, cur = snapshots(zero_to_null(lines(spark, sf), ["l_discount"]))
    return Q.run_suite(ref, cur, SUITE, SUITE_COLS, SUITE_NUM)


@query(
    "dq_tests",
    f"""with {DQ_SQL} select position, test, feature, case when ok then 'SUCCESS' else 'FAIL' end as status,
        round(value, 6) as value, round(lower, 6) as lower, round(upper, 6) as upper from tests""",
)
def _(spark, sf):
    return rounded(_suite(spark, sf))


@query(
    "dq_summary",
    f"""with {DQ_SQL} select count(*) as total_tests, count(*) filter (ok) as passed_tests,
        count(*) filter (not ok) as failed_tests from tests""",
)
def _(spark, sf):
    return Q.suite_summary(_suite(spark, sf))


@query(
    "dq_type_mismatch",
    f"""with {DQ_SQL} select position, test, feature,
          case when test = 'column_types' or test = 'drifted_columns' then 'FAIL'
               when feature = 'l_discount' then 'ERROR' when ok then 'SUCCESS' else 'FAIL' end as status,
          case when test = 'column_types' then 1 when test = 'drifted_columns' then d.n
               when feature <> 'l_discount' then round(value, 6) end as value
        from tests, (select count(*) + 1 as n from ({_psi_sql("l_quantity", "l")} union all {_psi_sql("l_extendedprice", "l")})
                     where psi >= 0.2::double) d
        where position >= 5 and position <> 6""",
)
def _(spark, sf):
    """The current discount is text: the suite reports it and goes on with the other columns."""
    ref, cur = snapshots(zero_to_null(lines(spark, sf), ["l_discount"]))
    cur = cur.withColumn("l_discount", F.concat(F.col("l_discount").cast("string"), F.lit("%")))
    tests = Q.run_suite(ref, cur, SUITE, SUITE_COLS, SUITE_NUM).where("position >= 5 and position <> 6")
    return rounded(tests.select("position", "test", "feature", "status", "value"))


def _conflict_sql(y: str) -> str:
    return f"""with {SCORED} select count(*) as n_groups, cast(coalesce(sum(n), 0) as bigint) as n_rows from (
        select count(*) as n from scored group by l_quantity, l_discount, l_tax having min({y}) <> max({y}))"""


@query("conflict_target", _conflict_sql("label"))
def _(spark, sf):
    return D.conflicts(scored_lines(spark, sf), ["l_quantity", "l_discount", "l_tax"], "label")


@query("conflict_prediction", _conflict_sql("prediction"))
def _(spark, sf):
    return D.conflicts(scored_lines(spark, sf), ["l_quantity", "l_discount", "l_tax"], "prediction")


@query(
    "conflict_language",
    """select count(*) as n_groups, cast(coalesce(sum(n), 0) as bigint) as n_rows from (
         select count(*) as n from documents group by text having min(source) <> max(source))""",
)
def _(spark, sf):
    return D.conflicts(table(spark, sf, "documents"), ["text"], "source", digest=["text"])
