"""Split, impute, scale, prepare."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import FEATURES, KEY, LINES, ROW, lines, query, rounded, workspace
from bindings.projections import ENGINEERED_SQL
from riskloom.operators import prep as Z
from riskloom.operators import split as S
from riskloom.operators.projection import zero_to_null

SPLIT_KEY_SQL = "concat('42;', " + ", ".join(
    f"coalesce(length({k}::varchar)::varchar || ':' || {k}::varchar || ';', 'n;')" for k in KEY
) + ")"
RANKED_SQL = f"""ranked as (
  select {ROW}, l_returnflag,
         row_number() over (partition by l_returnflag order by
           md5({SPLIT_KEY_SQL}))
           as rn,
         count(*) over (partition by l_returnflag) as n
  from lineitem),
marked as (select {ROW}, l_returnflag, rn <= ceil(round(0.2 * n, 9)) as is_test from ranked)"""


@query("stratified_split", f"with {RANKED_SQL} select {ROW}, l_returnflag, is_test from marked")
def _(spark, sf):
    return S.mark_test(lines(spark, sf).select(*KEY, "l_returnflag"), "l_returnflag", 0.2, 42, KEY)


@query(
    "union_splits",
    """select l_returnflag, count(*) as n, cast(sum(l_linenumber) as bigint) as line_sum
       from lineitem group by l_returnflag""",
)
def _(spark, sf):
    train, test = S.stratified_split(lines(spark, sf).select(*KEY, "l_returnflag"), "l_returnflag", 0.2, 42, KEY)
    return (
        S.union_splits(train, test)
        .groupBy("l_returnflag")
        .agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("line_sum"))
    )


CLEAN_SQL = "clean as (select l_quantity, l_extendedprice, nullif(l_discount, 0) as l_discount, nullif(l_tax, 0) as l_tax from lineitem)"


def _clean(spark, sf):
    return zero_to_null(lines(spark, sf).select(*FEATURES), ["l_discount", "l_tax"])


@query(
    "impute_stats",
    f"with {CLEAN_SQL} "
    + " union all ".join(f"select '{c}' as feature, round(quantile_cont({c}, 0.5), 6) as median from clean" for c in FEATURES),
)
def _(spark, sf):
    medians = Z.fit_impute(_clean(spark, sf), FEATURES)
    return rounded(spark.createDataFrame(list(medians.items()), "feature string, median double"))


def _scale_sql(c: str) -> str:
    return f"""select '{c}' as feature, round(quantile_cont(x, 0.5), 6) as center,
          round(case when quantile_cont(x, 0.75) = quantile_cont(x, 0.25) then 1
                else quantile_cont(x, 0.75) - quantile_cont(x, 0.25) end, 6) as scale
        from (select coalesce({c}, (select quantile_cont({c}, 0.5) from clean)) as x from clean)"""


@query("scale_stats", f"with {CLEAN_SQL} " + " union all ".join(_scale_sql(c) for c in FEATURES))
def _(spark, sf):
    clean = _clean(spark, sf)
    scaling = Z.fit_scale(clean, Z.fit_impute(clean, FEATURES))
    rows = [(c, center, scale) for c, (center, scale) in scaling.items()]
    return rounded(spark.createDataFrame(rows, "feature string, center double, scale double"))


NUMERIC = LINES.numeric


def _prep_sql(source: str) -> str:
    """Medians, quartiles of the imputed columns, then the transform, for rows of ``source``."""
    med = ", ".join(f"quantile_cont({c}, 0.5) as m_{c}" for c in NUMERIC)
    quart = ", ".join(
        f"quantile_cont(coalesce({c}, m_{c}), 0.25) as a_{c}, quantile_cont(coalesce({c}, m_{c}), 0.5) as b_{c}, "
        f"quantile_cont(coalesce({c}, m_{c}), 0.75) as e_{c}"
        for c in NUMERIC
    )
    return f"med as (select {med} from {source}), quart as (select {quart} from {source}, med)"


def _scaled(c: str) -> str:
    return f"(coalesce({c}, m_{c}) - b_{c}) / case when e_{c} = a_{c} then 1 else e_{c} - a_{c} end"


@query(
    "impute_scale",
    f"""with {ENGINEERED_SQL}, {_prep_sql("engineered")}
        select {ROW}, {", ".join(f"round({_scaled(c)}, 6) + 0::double as {c}" for c in NUMERIC)},
               {", ".join(LINES.dummies)} from engineered, med, quart""",
)
def _(spark, sf):
    df = lines(spark, sf).select(*KEY, *FEATURES)
    _model, out = Z.PrepModel(LINES).fit_transform(df)
    return rounded(out)


@query(
    "prepare",
    f"""with {RANKED_SQL}, {ENGINEERED_SQL},
        parts as (select e.*, m.is_test from engineered e join marked m using ({ROW})),
        fitted as (select * from parts where not is_test), {_prep_sql("fitted")}
        select case when is_test then 'test' else 'train' end as part, count(*) as n,
               {", ".join(f"round(avg({_scaled(c)}), 6) + 0::double as {c}" for c in NUMERIC)},
               {", ".join(f"count(*) filter ({c}) as {c}" for c in LINES.dummies)}
        from parts, med, quart group by 1""",
)
def _(spark, sf):
    df = lines(spark, sf).select(*KEY, "l_returnflag", *FEATURES)
    train, test = S.written_split(df, "l_returnflag", 0.2, 42, KEY, workspace(spark, "splits"))
    _model, train, test = Z.prepare(train, test, LINES)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return rounded(
        both.groupBy("part").agg(
            F.count("*").alias("n"),
            *[F.avg(c).alias(c) for c in NUMERIC],
            *[F.count_if(c).alias(c) for c in LINES.dummies],
        )
    )
