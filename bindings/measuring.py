"""Classification metrics, gate, run tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.base import CUR_SQL, REF_SQL, SCORED, query, rounded, scored_lines, snapshots, table
from riskloom.operators import metrics as M
from riskloom.operators import registry as R

COUNTS_SQL = """count(*) filter (label = 1 and prediction = 1) as tp, count(*) filter (label = 0 and prediction = 1) as fp,
  count(*) filter (label = 1 and prediction = 0) as fn, count(*) filter (label = 0 and prediction = 0) as tn"""
RATIOS_SQL = """(tp + tn) / (tp + fp + fn + tn) as accuracy, coalesce(tp / nullif(tp + fp, 0), 0) as precision,
  coalesce(tp / nullif(tp + fn, 0), 0) as recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1_score"""


def _auc_sql(source: str, y: str, score: str) -> str:
    return f"""(select sum(pos * (before + neg / 2)) / (sum(pos)::double * sum(neg)) from (
       select pos, neg, coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0) as before
       from (select {score} as s, count(*) filter ({y} = 1) as pos, count(*) filter ({y} = 0) as neg
             from {source} group by 1)))"""


@query(
    "binary_metrics",
    f"""with {SCORED}, c as (select {COUNTS_SQL} from scored), m as (select *, {RATIOS_SQL} from c)
        select tp, fp, fn, tn, round(accuracy, 6) as accuracy, round(precision, 6) as precision,
               round(recall, 6) as recall, round(f1_score, 6) as f1_score from m""",
)
def _(spark, sf):
    return rounded(M.binary_metrics(scored_lines(spark, sf), "label", "prediction"))


@query("roc_auc", f"with {SCORED} select round({_auc_sql('scored', 'label', 'probability')}, 6) as roc_auc")
def _(spark, sf):
    return rounded(M.roc_auc(scored_lines(spark, sf), "label", "probability"))


@query(
    "roc_auc_ties",
    f"with {SCORED} select round({_auc_sql('scored', 'label', 'l_quantity')}, 6) as roc_auc",
)
def _(spark, sf):
    # Few distinct scores (each value is shared by 2 % of the rows) and several value buckets.
    return rounded(M.roc_auc(scored_lines(spark, sf), "label", "l_quantity", rows_per_bucket=10_000))


@query(
    "confusion",
    f"with {SCORED} select label as actual, prediction as predicted, count(*) as n from scored group by 1, 2",
)
def _(spark, sf):
    return M.confusion(scored_lines(spark, sf), "label", "prediction")


_THREE = "case when l_quantity > 45 then 2 else label end as actual"


@query(
    "confusion_three_classes",
    f"""with {SCORED}, c as (select {_THREE}, prediction as predicted from scored), k as (select unnest([0, 1, 2]) as class)
        select a.class::integer as actual, p.class::integer as predicted,
               (select count(*) from c where actual = a.class and predicted = p.class) as n from k a, k p""",
)
def _(spark, sf):
    """A class that nobody declared and nobody predicts."""
    actual = F.when(F.col("l_quantity") > 45, 2).otherwise(F.col("label"))
    return M.confusion(scored_lines(spark, sf).withColumn("actual", actual), "actual", "prediction")


@query(
    "quality_by_class",
    f"""with {SCORED}, s as (
          select k.class, count(*) filter (label = k.class) as support, count(*) filter (prediction = k.class) as predicted,
                 count(*) filter (label = k.class and prediction = k.class) as hits
          from scored, (select distinct label as class from scored) k group by k.class)
        select class, support, round(hits / predicted, 6) as precision, round(hits / support, 6) as recall,
               round(2 * hits / (predicted + support), 6) as f1 from s""",
)
def _(spark, sf):
    return rounded(M.by_class(scored_lines(spark, sf), "label", "prediction"))


@query(
    "class_balance",
    f"""with {SCORED} select label as class, count(*) filter ({REF_SQL}) as n_ref, count(*) filter ({CUR_SQL}) as n_cur,
          round(count(*) filter ({REF_SQL}) / (select count(*) from scored where {REF_SQL}), 6) as share_ref,
          round(count(*) filter ({CUR_SQL}) / (select count(*) from scored where {CUR_SQL}), 6) as share_cur
        from scored group by label""",
)
def _(spark, sf):
    ref, cur = snapshots(scored_lines(spark, sf))
    return rounded(M.class_balance(ref, cur, "label"))


@query(
    "performance",
    f"""with {SCORED}, cur as (select * from scored where {CUR_SQL}),
        c as (select {COUNTS_SQL} from cur), m as (select *, {RATIOS_SQL} from c),
        w as (select *, {_auc_sql('cur', 'label', 'probability')} as roc_auc from m),
        classes as (
          select 0 as class, tn as hits, tn + fn as predicted, tn + fp as support, * from w
          union all select 1, tp, tp + fp, tp + fn, * from w)
        select section, name, round(value, 6) as value from (
          select 'quality' as section, 'accuracy' as name, accuracy as value from w
          union all select 'quality', 'precision', precision from w
          union all select 'quality', 'recall', recall from w
          union all select 'quality', 'f1_score', f1_score from w
          union all select 'quality', 'roc_auc', roc_auc from w
          union all select 'confusion', 'actual_1_predicted_1_n', tp::double from w
          union all select 'confusion', 'actual_0_predicted_1_n', fp::double from w
          union all select 'confusion', 'actual_1_predicted_0_n', fn::double from w
          union all select 'confusion', 'actual_0_predicted_0_n', tn::double from w
          union all select 'by_class', concat('class_', class, '_precision'), hits / predicted from classes
          union all select 'by_class', concat('class_', class, '_recall'), hits / support from classes
          union all select 'by_class', concat('class_', class, '_f1'), 2 * hits / (predicted + support) from classes
          union all select 'class_balance', concat('class_', label, '_share_ref'),
              count(*) filter ({REF_SQL}) / (select count(*) from scored where {REF_SQL}) from scored group by label
          union all select 'class_balance', concat('class_', label, '_share_cur'),
              count(*) filter ({CUR_SQL}) / (select count(*) from scored where {CUR_SQL}) from scored group by label)""",
)
def _(spark, sf):
    ref, cur = snapshots(scored_lines(spark, sf))
    return rounded(M.performance_report(cur, "label", "prediction", "probability", ref))


# --- one "run" per supplier: its lines scored by the fixed rule -----------------

RUNS_SQL = f"""{SCORED}, c as (select l_suppkey, {COUNTS_SQL} from scored group by l_suppkey),
  runs as (select *, {RATIOS_SQL} from c)"""
MINIMUMS = {"accuracy": 0.85, "precision": 0.85, "recall": 0.92, "f1_score": 0.88}


def supplier_runs(spark, sf) -> DataFrame:
    return M.binary_metrics(scored_lines(spark, sf), "label", "prediction", ["l_suppkey"])


@query(
    "gate",
    f"""with {RUNS_SQL} select l_suppkey,
          concat_ws(';', {", ".join(f"case when {m} < {low}::double then '{m}' end" for m, low in MINIMUMS.items())}) as failures,
          {" and ".join(f"{m} >= {low}::double" for m, low in MINIMUMS.items())} as passed from runs""",
)
def _(spark, sf):
    out = M.gate(supplier_runs(spark, sf), MINIMUMS)
    return out.select("l_suppkey", F.concat_ws(";", "failures").alias("failures"), "passed")


@query(
    "pick_best",
    f"""with {RUNS_SQL} select model, position, nation, round(f1_score, 6) as f1_score from (
          select s_name as model, s_suppkey as position, s_nationkey as nation, f1_score,
                 row_number() over (partition by s_nationkey order by f1_score desc, s_suppkey) as rn
          from runs join supplier on l_suppkey = s_suppkey where f1_score > 0) where rn = 1""",
)
def _(spark, sf):
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("position"), F.col("s_name").alias("model"), F.col("s_nationkey").alias("nation")
    )
    runs = supplier_runs(spark, sf).select(F.col("l_suppkey").alias("position"), "f1_score")
    return rounded(M.pick_best(runs.join(suppliers, "position"), keys=["nation"]))


@query(
    "comparison",
    f"""with {RUNS_SQL} select s_name as model, round(accuracy, 6) as accuracy, round(f1_score, 6) as f1_score
        from runs join supplier on l_suppkey = s_suppkey""",
)
def _(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("model"))
    return rounded(M.comparison(supplier_runs(spark, sf).join(suppliers, "l_suppkey"), ["accuracy", "f1_score"]))


@query(
    "run_leaderboard",
    f"""with {RUNS_SQL} select s_suppkey as run_id, s_name as run_name, round(accuracy, 6) as accuracy,
          round(f1_score, 6) as f1_score, round(recall, 6) as recall
        from supplier left join runs on l_suppkey = s_suppkey""",
)
def _(spark, sf):
    runs = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("run_id"), F.col("s_name").alias("run_name"))
    names = ["accuracy", "f1_score", "recall"]
    long = supplier_runs(spark, sf).unpivot("l_suppkey", names, "name", "value").withColumnRenamed("l_suppkey", "run_id")
    return rounded(R.run_leaderboard(runs, long, names))


@query(
    "latest_version",
    """select name, version, stage from (
         select o_custkey as name, o_orderkey as version,
                case o_orderstatus when 'F' then 'Production' when 'P' then 'Staging' else 'None' end as stage,
                row_number() over (partition by o_custkey order by
                  case o_orderstatus when 'F' then 0 when 'P' then 1 else 2 end, o_orderkey desc) as rn
         from orders) where rn = 1""",
)
def _(spark, sf):
    stage = F.when(F.col("o_orderstatus") == "F", "Production").when(F.col("o_orderstatus") == "P", "Staging")
    versions = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("name"), F.col("o_orderkey").alias("version"), stage.otherwise("None").alias("stage")
    )
    return R.latest_version(versions)
